"""Hard negatives, sharding and alignment of tokenizers against brute force, on awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlumen.llm import common, cross_align, hard_negatives, sharding
from adlumen.llm.queries import QUERIES
from conftest import TABLES

CLASHING = ["id", "block", "row", "shard", "slice", "rank", "kind", "groups", "a.b", "place", "draw"]


@pytest.fixture(scope="module")
def rows(spark):
    found = [(r[0], r[1]) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).collect()]
    return found + [
        (900, None), (901, ""), (902, " \t\n"), (903, found[5][1]), (904, found[5][1]), (904, found[6][1]), (904, found[6][1]), (905, "a▁b and more"), (906, "<|endoftext|> <s>plain</s><unk>"),
        (907, "漢字かな交じり文" * 300), (908, "  two  spaces\n\n and\ttabs "), (909, "x" * 5000), (910, "ﬁne ½ 　wide\x00 zero"), (None, "no id"), (None, None), (-3, found[7][1] * 40),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.ship(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.select("*", *(F.lit("clash").alias(k) for k in CLASHING))


# --- alignment of tokenizers ----------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def plain_alignment(text, left, right):
    """(first ids, second ids, links, groups) of one text, byte by byte."""
    if not text:
        return [], [], [], []
    a, b, letters = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text), byte_letters()
    a_bytes = [bytes(letters[x] for x in left.id_to_token(k)) for k in a]
    b_bytes = [bytes([int(right.id_to_piece(k)[3:5], 16)]) if right.is_byte(k) else right.id_to_piece(k).replace("▁", " ").encode() for k in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []
    owner = [[n for n, x in enumerate(sizes) for _ in x] for sizes in (a_bytes, b_bytes)]
    links = sorted(set(zip(*owner)))
    a_ends, b_ends = ({sum(map(len, x[: n + 1])) for n in range(len(x))} if len(x) < 200 else set(np.cumsum([len(y) for y in x]).tolist()) for x in (a_bytes, b_bytes))
    groups, start = [], 0
    for end in sorted(a_ends & b_ends):
        groups.append(tuple([ids[n] for n in sorted(set(own[start:end]))] for ids, own in zip((a, b), owner)))
        start = end
    return a, b, [(a[x], b[y]) for x, y in links], groups


def expected_alignment(rows, tokenizers):
    each = [(ident, plain_alignment(text, *tokenizers)) for ident, text in rows]
    counts = Counter(pair for _, x in each for pair in x[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = [
        (i, len(a), len(b), len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), ";".join(f"{','.join(map(str, u))}|{','.join(map(str, v))}" for u, v in g))
        for i, (a, b, links, g) in each
    ]
    return out, counts, most


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("fan, block, slices", [(64, 4 << 20, None), (2, 20_000, 3)])
def test_alignment(docs, rows, tokenizers, fan, block, slices, monkeypatch):
    monkeypatch.setattr(cross_align, "FAN", fan)
    monkeypatch.setattr(cross_align, "BLOCK_BYTES", block)
    want, counts, most = expected_alignment(rows, tokenizers)
    assert in_order(cross_align.align(docs, slices=slices).collect()) == in_order(want)
    got = cross_align.pair_counts(docs, slices=slices).collect()
    assert {(r.a, r.b): r.links for r in got} == dict(counts) and len(got) == len(counts)
    assert all(r.best == (r.links == most[r.b]) for r in got)


def test_remembered_segments_change_no_ids(rows, monkeypatch):
    monkeypatch.setattr(cross_align, "CACHE", 40)
    monkeypatch.setattr(cross_align, "CACHED_CHARS", 6)
    texts = [t or "" for _, t in rows] + ["a▁b", "", "plain words, plain words", "y" * 70]
    model = cross_align.Both("byte_bpe_50k", "piece_bpe_32k")
    for size in (1, 7, len(texts), 3):
        for k in range(0, len(texts), size):
            some = texts[k : k + size]
            a, b, sizes = model.encode_all(some)
            assert all(len(s) <= 6 for s in model.seen) and len(model.seen) == len(model.covered)
            alone = []
            for text in some:
                model_ids = cross_align.both("byte_bpe_50k", "piece_bpe_32k")
                left, right = model_ids.left.model.encode_ordinary(" " + text), model_ids.right.encode(text)
                alone.append((left, right) if text and model_ids._covers(b" " + text.encode(), left, right) else ([], []))
            assert a.tolist() == [i for x, _ in alone for i in x] and b.tolist() == [i for _, x in alone for i in x]
            assert sizes.tolist() == [[len(x), len(y)] for x, y in alone]


def test_alignment_takes_rows_in_bounded_batches(spark, docs):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    assert cross_align.align(docs.limit(20)).count() == 20
    # Blocks of texts are rows of up to a megabyte; ten thousand of them would be one batch.
    rows = spark.range(0, 30, 1, 1).select(F.expr("repeat('x', 1048576)").alias("block"))
    sizes = [r[0] for r in rows.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [one.num_rows]}) for one in it), "n long").collect()]
    assert sum(sizes) == 30 and max(sizes) <= 5


@given(st.text(st.sampled_from("ab Zé漢\n\t'9 .▁😀 "), max_size=40))
@settings(max_examples=300, deadline=None)
def test_segments_encode_as_the_whole_text(text):
    left, right = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    left.encode_special_tokens = True
    [(a, b)] = cross_align.both("byte_bpe_50k", "piece_bpe_32k").encode([text])
    if not text or "▁" in text:
        assert a == b == b""
    else:
        assert np.frombuffer(a, np.uint32).tolist() == left.encode(" " + text, add_special_tokens=False).ids
        assert np.frombuffer(b, np.uint32).tolist() == right.encode(text)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64)
    made = cross_align.PerfectHash.build(keys)
    read = cross_align.PerfectHash.from_bytes(made.to_bytes())
    assert sorted(read.index(keys).tolist()) == list(range(n))
    assert 8 * len(made.to_bytes()) < 4 * n + 64 * 60


def test_alignment_digest_of_texts_without_tokens(spark):
    got = QUERIES["op13_cross_tokenizer_alignment"](spark, TABLES)
    assert dict(got.dtypes) == {**{k: "bigint" for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}, "groups_sha256": "string"}
    empty = {r[0] for r in spark.read.parquet(f"{TABLES}/documents.parquet").where("coalesce(text, '') = ''").select("doc_id").collect()}
    for r in got.collect():
        assert (r.groups_sha256 == "") == (r.n_a == 0) and (r.doc_id not in empty or r.n_a == 0)


# --- sharding -------------------------------------------------------------------------------


def test_shards_hold_every_row_once(docs, rows):
    for shards in (1, 7, 200):
        got = sharding.shuffle_into_shards(docs, shards).collect()
        assert in_order((r.row["doc_id"], r.row["text"]) for r in got) == in_order(rows)
        sizes = Counter(r.shard for r in got)
        assert all(sizes[k] == len(rows) // shards + (k < len(rows) % shards) for k in range(shards))
        assert sorted((r.shard, r.slot) for r in got) == [(k, n) for k in range(shards) for n in range(sizes[k])]
        assert got[0].row.asDict().keys() == {"doc_id", "text", *CLASHING}


def test_bins_keep_slots_gapless_and_the_result_repeats(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BIN_ROWS", 4)
    monkeypatch.setattr(sharding, "BLOCK_BITS", 3)
    got = [sharding.shuffle_into_shards(docs.coalesce(1), 3, seed=s).select("row.doc_id", "shard", "slot").collect() for s in (5, 5, 6)]
    assert in_order(got[0]) == in_order(got[1]) != in_order(got[2])
    for one in got:
        sizes = Counter(r.shard for r in one)
        assert sorted((r.shard, r.slot) for r in one) == [(k, n) for k in range(3) for n in range(sizes[k])]


def test_digest_of_shards(docs, rows):
    got = sharding.sharded_digest(sharding.shuffle_into_shards(docs, 4)).collect()
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows", None) for i, t in rows]
    assert in_order((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in got) == in_order(want)


def test_matrix_has_the_sums_it_was_drawn_for():
    sizes, places = [5, 0, 17, 1, 40], [20, 21, 22]
    drawn = sharding.communication_rows((1, 2), sizes, places)
    assert [sum(x) for x in drawn] == sizes and [sum(x) for x in zip(*drawn)] == places


@pytest.mark.parametrize("good, bad, drawn", [(5, 7, 6), (3, 40, 8), (30, 4, 12), (1, 1, 1), (0, 4, 2), (4, 0, 2)])
def test_draws_follow_the_hypergeometric_law(good, bad, drawn):
    rng, n = np.random.default_rng(9), 20_000
    got = Counter(sharding.hypergeometric(rng, good, bad, drawn) for _ in range(n))
    for k in range(drawn + 1):
        want = n * math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(good + bad, drawn)
        assert abs(got[k] - want) <= 5 * math.sqrt(want) + 1e-9


def test_draws_from_more_rows_than_doubles_count_well():
    rng = np.random.default_rng(3)
    got = np.array([sharding.hypergeometric(rng, 10**12, 39 * 10**12, 10**9) for _ in range(300)])
    assert abs(got.mean() - 25e6) < 5 * 4937 / math.sqrt(300) and abs(got.std() / 4937 - 1) < 0.25


def test_places_are_uniform(spark):
    """Each of 6 rows in 2 blocks is at each of the 6 places equally often."""
    common.ship(spark)
    docs = spark.createDataFrame([(k, "x") for k in range(6)], "doc_id long, text string").repartitionByRange(2, "doc_id")
    rng, n = np.random.default_rng(1), 3000
    got = Counter()
    for seed in range(n):  # the same steps as the operator's, without a Spark job for each
        drawn = sharding.communication_rows((seed, 0), [2, 4], [3, 3])
        for block, counts in enumerate(drawn):
            for place, shard in enumerate(np.random.default_rng((seed, 2, block)).permutation(np.repeat([0, 1], counts)).tolist()):
                got[block, place, shard] += 1
    assert all(abs(x - n / 2) < 5 * math.sqrt(n / 4) for x in got.values()) and len(got) == 12
    assert sharding.shuffle_into_shards(docs, 2).count() == 6 and rng is not None


# --- hard negatives -------------------------------------------------------------------------


def plain_hard_negatives(rows, every, n_positives, n_negatives):
    seen = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            seen.setdefault(i, []).append((label, v))
    of = {i: min(x) for i, x in seen.items()}
    of = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in of.items()}
    of = {i: x for i, x in of.items() if sum(k * k for k in x[1]) < 2**62}
    out = []
    for a, (label, v) in of.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in of.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if of[i][0] == label][:n_positives]:
            found = [i for i in order if of[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:n_negatives]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(found)]
    return sorted(out)


def vectors(n, width, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width)) + rng.normal(size=width)
    kinds = rng.integers(0, labels, n)
    return [(k, int(kinds[k]), (centres[kinds[k]] + 0.8 * rng.normal(size=width)).round(2).tolist()) for k in range(n)]


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("anchors, cells", [(1 << 15, 1 << 18), (4, 2000)])
def test_hard_negatives(spark, anchors, cells, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "BLOCK_CELLS", cells)
    common.ship(spark)
    base = vectors(300, 24, 1)
    odd = [
        (300, None, [1.0]), (310, 1, None), (320, 1, [1.0, None]), (330, 1, [float("nan")]), (340, 1, [float("inf"), 1.0]), (None, 1, [1.0] * 24), (350, 1, []), (360, 2, [2.0] * 5),
        (370, 0, [1e300] * 3), (10, base[10][1], base[10][2]), (20, 9, [9.0] * 24), (380, 1, [0.5] * 150), (390, 2, [0.5] * 150), (400, 7, [1.0]), *((500 + k, k % 2, [1.0, 2.0, 3.0]) for k in range(40)),
    ]
    frame = spark.createDataFrame(base + odd, SCHEMA).repartition(5).select("*", *(F.lit("clash").alias(k) for k in CLASHING))
    got = hard_negatives.mine(frame, every=10, positives=3, negatives=4)
    want = plain_hard_negatives(base + odd, 10, 3, 4)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100
    assert dict(got.dtypes) == {"rank": "int", **{k: "bigint" for k in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")}}


def test_scores_beyond_exact_doubles(spark):
    common.ship(spark)
    rng = np.random.default_rng(4)
    rows = [(k, k % 2, (rng.random(4) * 2**20 + 2**20).round(3).tolist()) for k in range(60)]
    assert max(x for _, _, v in rows for x in v) * 256 > 2**28
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), every=10, positives=2, negatives=3)
    assert sorted(tuple(r) for r in got.collect()) == plain_hard_negatives(rows, 10, 2, 3)


@pytest.mark.parametrize("width", [3, 64, 100])
def test_segments_bound_the_scores(width):
    rng = np.random.default_rng(width)
    padded = -(-width // 64) * 64
    values = np.zeros((50, padded))
    values[:, :width] = np.floor(256 * rng.normal(size=(50, width)))
    made = hard_negatives.Vectors.of(np.arange(50), np.zeros(50, np.int64), values)
    exact, spans = values @ values.T, []
    for mean, deviation in zip(made.means, made.deviations):
        middle, reach = mean @ mean.T, deviation @ deviation.T
        assert (middle - reach <= exact + 1e-3).all() and (exact <= middle + reach + 1e-3).all()
        spans.append(reach.mean())
    assert spans == sorted(spans, reverse=True)  # finer segments bound closer
    read = hard_negatives.Vectors.from_row({**made.to_row()})
    assert (read.values == made.values).all() and all((x == y).all() for x, y in zip(read.means + read.deviations, made.means + made.deviations))


def test_bounds_leave_few_pairs_to_score_where_vectors_cluster():
    rng = np.random.default_rng(2)
    def of(labels):
        values = np.floor(256 * (np.repeat(rng.normal(size=(len(labels), 4)), 16, axis=1) + 0.05 * rng.normal(size=(len(labels), 64))))
        return hard_negatives.Vectors.of(np.arange(len(labels)), labels, values)
    x, y = of(np.zeros(40, np.int64)), of(np.zeros(400, np.int64))
    exact = x.values @ y.values.T
    low = np.quantile(exact, 0.95, axis=1)
    a, r, score = hard_negatives.scored_pairs(x, y, np.ones(exact.shape, bool), low, np.full(40, np.inf))
    assert len(a) < 0.12 * exact.size and set(zip(*np.nonzero(exact >= low[:, None]))) <= set(zip(a.tolist(), r.tolist()))
    assert (score == exact[a, r]).all()


def test_empty_tables(spark):
    common.ship(spark)
    none = spark.createDataFrame([], "doc_id long, text string, block string")
    assert cross_align.align(none).count() == cross_align.pair_counts(none).count() == sharding.shuffle_into_shards(none).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert in_order(cross_align.align(nothing).collect()) == in_order([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])
