"""The text operators against brute force, on small tables with awkward rows.

``docs`` holds documents of the smallest table and rows with null, empty, blank, very long and
repeated texts, a null id, and columns whose names the operators use themselves.
"""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlumen.llm import (
    common, components, decontaminate, fingerprints, html_text, language, line_dedup, near_dedup, packing, repeats,
    substring_dedup, suffix_dedup, token_counts,
)
from adlumen.llm.tokens import encoder
from conftest import TABLES

CLASHING = ["id", "packed", "key", "label", "part", "size", "kept", "score", "lang_pred", "range", "guest", "next", "sketch", "v", "lines"]
PASSAGE = " ".join(f"passage{k}" for k in range(60))


@pytest.fixture(scope="module")
def rows(spark):
    found = [(r[0], r[1], r[2]) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").limit(90).collect()]
    a, b = found[5][1], found[7][1]
    return found + [
        (900, None, "en"), (901, "", None), (902, " \t\n", "en"), (903, a, "en"), (904, a, "en"), (904, a, "en"), (905, b + " one more word", None),
        (906, (a + " ") * 60, "en"), (907, PASSAGE + " first end", "en"), (908, "some start " + PASSAGE, "en"), (909, "ab " * 300, "en"), (910, "x", "en"),
        (-5, PASSAGE, "en"), (911, "line one is a line of text here\nline two\n\nline two\nline one is a line of teXt here", "en"), (None, a, "en"), (None, None, None), (912, "مرحبا بك", None),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.ship(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return frame.select("*", *(F.lit("clash").alias(k) for k in CLASHING))


def by_id(frame):
    """Rows of documents with an id; rows repeated under one id have to agree."""
    out = {}
    for row in frame.collect():
        assert out.setdefault(row["doc_id"], row) == row or row["doc_id"] is None
    return out


def words(text):
    return (text or "").encode().split()


def shingles(text, n):
    w = [x.lower() for x in words(text)]
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def test_near_duplicates(spark, docs, rows):
    result = near_dedup.near_duplicates(docs, shingle=4)
    assert result.count() == len(rows)
    got = by_id(result)
    sets = {i: shingles(t, 4) for i, t, _ in rows if i is not None}
    group = {i: i for i in sets}
    for _ in range(len(sets)):
        before = dict(group)
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    group[i] = min(group[i], group[j])
        if group == before:
            break
    for i, s in sets.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), group[i], group[i] == i)
    assert got[None].component_id is None and got[None].kept is None


def test_near_duplicates_in_one_large_bucket(spark):
    """Edited copies of one text: all find the original, although copies differ among themselves."""
    base = [f"w{k}" for k in range(200)]
    texts = [(k, " ".join(base[: 3 * k] + [f"new{k}", f"more{k}"] + base[3 * k + 2 :])) for k in range(40)] + [(99, " ".join(base))]
    texts += [(200 + k, " ".join(base[:60] + [f"other{k}_{j}" for j in range(100)])) for k in range(20)]
    sets = {i: shingles(t, 4) for i, t in texts}
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=4))
    assert {got[k].component_id for k in range(40)} == {0} and got[99].component_id == 0
    assert all(got[200 + k].component_id == 200 + k for k in range(20))
    assert all(got[i].n_shingles == len(s) for i, s in sets.items())


def test_pairs_of_different_components_in_a_large_bucket(spark):
    """What the pivot does not link is found by rare shingles."""
    left, right = [f"l{k}" for k in range(100)], [f"r{k}" for k in range(100)]
    texts = {1: left, 2: left[:96] + ["x"] * 4, **{k: [f"o{k}_{j}" for j in range(100)] for k in range(3, 30)}, 50: right, 51: right[:97] + ["y"] * 3}
    frame = spark.createDataFrame([(i, common.compress(" ".join(t).encode())) for i, t in texts.items()], "id long, packed binary")
    members = spark.createDataFrame([(7, i, len(shingles(" ".join(t), 4)), 100 if i == 1 else 1) for i, t in texts.items()], "key long, id long, size long, weight long")
    labels = {r.v: r.label for r in near_dedup.bucket_links(members, frame, 4, 80).collect()}
    assert labels == {2: 1, 51: 50}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, 200 + k) for k in range(30)] + [(500, 500)]
    got = {r.v: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 21)}, **{200 + k: 100 for k in range(30)}}


def brute_words(rows, width):
    first = {}
    for i, t, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = {}
    for i, t, _ in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.setdefault(i, []).append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("crowd", [256, 3])
def test_substring_dedup(docs, rows, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    want = brute_words(rows, 13)
    got = substring_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) in want[r.doc_id]


def brute_bytes(rows, width):
    seen = Counter()
    for i, t, _ in rows:
        raw = (t or "").encode()
        seen.update(raw[k : k + width] for k in range(len(raw) - width + 1) if i is not None)
    out = {}
    for i, t, _ in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - width + 1):
            if i is not None and seen[raw[k : k + width]] > 1:
                gone[k : k + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.setdefault(i, []).append((len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("crowd", [256, 3])
def test_suffix_dedup(docs, rows, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    want = brute_bytes(rows, 200)
    got = suffix_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) in want[r.doc_id]


def test_suffix_sort_is_a_sort():
    data = np.frombuffer((b"abracadabra banana " * 30 + b"z") * 2, np.uint8)
    places = np.arange(0, 900)
    segment = places % 3
    by = np.argsort(segment, kind="stable")
    order = by[suffix_dedup.suffix_sort(suffix_dedup.Extensions(data, 50), places[by], segment[by])]
    raw = data.tobytes()
    assert order.tolist() == sorted(range(900), key=lambda k: (segment[k], raw[places[k] : places[k] + 50], k))


def test_colliding_hashes_are_found_by_their_bytes(monkeypatch):
    """With a hash that cannot tell bytes apart, verification falls back to the bytes."""
    monkeypatch.setattr(suffix_dedup.Extensions, "common", lambda self, x, y: np.full(len(x), self.width))
    texts = [b"a" * 30, b"b" * 30, b"a" * 30]
    owner, inner = suffix_dedup.repeated_suffixes(texts, np.array([1, 1, 1], np.uint64), np.array([1, 1, 1]), np.zeros(3, bool), 30, np.zeros(3, np.int64))
    assert owner.tolist() == [0, 2]


def test_line_dedup(docs, rows):
    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        k = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]

    seen, want = [], {}
    for i, t, _ in sorted(((i, t, n) for n, (i, t, _) in enumerate(rows) if i is not None), key=lambda r: (r[0], r[2])):
        if i in want:
            continue
        n, gone, kept = 0, 0, []
        for line in (t or "").split("\n"):
            s = line.strip()
            n += bool(s)
            if s and any(s == o or (min(len(s), len(o)) >= 24 and near(s, o)) for o in seen):
                gone += 1
            else:
                kept.append(line)
            if s:
                seen.append(s)
        want[i] = (n, gone, "\n".join(kept))
    result = line_dedup.remove_lines(docs)
    assert result.count() == len(rows) and result.columns == ["doc_id", "n_lines", "n_removed", "kept"]
    for r in result.collect():
        assert (r.n_removed == 0) if r.doc_id is None else (r.n_lines, r.n_removed, r.kept) == want[r.doc_id]


def test_fingerprints(docs, rows):
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == len(rows)
    chain = sorted(((i, t or "") for i, t, _ in rows if i is not None), key=lambda r: (-r[0], r[1]))
    want = defaultdict(list)
    for k, (i, t) in enumerate(chain):
        after = chain[(k + 1) % len(chain)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        want[i].append((len(t), hashlib.sha256(edited.encode()).hexdigest()))
    prints = {}
    texts = dict(chain)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert (r.n_chars, r.edited_sha256) in want[r.doc_id]
            assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert prints[""] == "*"


def test_sketches_estimate_containment(spark):
    part, whole = [f"s{k}" for k in range(3000)], [f"s{k}" for k in range(30000)]
    frame = spark.createDataFrame([(" ".join(part), " ".join(whole), " ".join(whole[:50]))], "a string, b string, short string")
    for name in ("a", "b", "short"):
        frame = fingerprints.with_sketch(frame, name, f"{name}_sketch")
    row = frame.select(fingerprints.containment("a_sketch", "b_sketch").alias("x"), fingerprints.containment("short_sketch", "a_sketch").alias("y"), F.size("b_sketch.hashes").alias("n")).first()
    assert row.x == 1.0 and row.y == 1.0 and 3000 < row.n < 4500


def test_packing(docs, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(docs).collect()
    filled, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for spans in filled.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r.length for r in got)
    assert len(filled) <= -(-total // 1024) * 1.05 + 2
    want = defaultdict(list)
    for i, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        at = piece = 0
        while at < len(ids):
            to = at + ((len(ids) - at) % 1024 or 1024)
            want[i].append((piece, at, to - at, zlib.crc32(np.array(ids[at:to], "<u4").tobytes())))
            at, piece = to, piece + 1
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}


def test_packing_plan_uses_every_piece_once():
    counts = {1: 40, 3: 7, 100: 55, 341: 90, 342: 3, 512: 20, 513: 21, 700: 31, 1000: 12, 1023: 5, 1024: 9}
    plan = packing.packing_plan(counts)
    used = Counter()
    for contents, n in plan:
        assert sum(contents) <= 1024 and n > 0
        for length in contents:
            used[length] += n
    assert used == counts and packing.packing_plan({}) == []


def test_token_counts(docs, rows):
    model = encoder()
    result = token_counts.count_tokens(docs, token_counts.sample_edits())
    got = result.collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(t or "")
    for r in got:
        assert r.n_tokens in {len(model.plain(t)) // 4 for t in texts[r.doc_id]}
        assert r.n_tokens_edited == len(model.plain(r.edited)) // 4 and r.n_chars_edited == len(r.edited)
    long = next(r for r in got if r.doc_id == 906)
    assert 0 < long.n_chars_encoded < long.n_chars_edited / 5
    assert all(r.n_edits == 0 and r.n_tokens == r.n_tokens_edited for r in token_counts.count_tokens(docs).collect())


@pytest.mark.parametrize("start, length, new", [(-3, 2, "a"), (0, 0, ""), (10**6, 5, " end"), (5, 10**6, ""), (0, 10**6, "all  new\n"), (250, 20, " "), (3, 1, "  ")])
def test_edits_agree_with_encoding_again(rows, start, length, new):
    model = encoder()
    for _, text, _ in rows[:25]:
        tree = token_counts.TokenTree(text, model)
        tree.edit(start, length, new)
        at = min(max(start, 0), len(text))
        edited = text[:at] + new + text[at + length :]
        assert "".join(tree.leaves) == edited and tree.tokens[1] == len(model.plain(edited)) // 4


@pytest.mark.parametrize("text", ["<|endoftext|>", "one text.<|endoftext|>Next text", "<|endoftext|>start", "end<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>  b", "\n<|endoftext|>\n", "x<|endoftext|><|endoftext|> y", "<|endoftext|", "it<|endoftext|>'s", "é<|endoftext|>" * 40 + " " + "word " * 200 + "<|endoftext|>"])
def test_added_tokens_are_one_id(text):
    model, tokenizer = encoder(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert model.encode(text) == model.plain(text) == want
    tree = token_counts.TokenTree(text, model)
    assert tree.tokens[1] == len(want) // 4
    # Edits that cut a token, close one and put one in.
    for start, length, new in [(3, 2, ""), (3, 0, text[3:5]), (len(text) // 2, 0, "<|endoftext|>"), (0, 0, "<|endof"), (7, 0, "text|>")]:
        tree.edit(start, length, new)
        assert tree.tokens[1] == len(tokenizer.encode("".join(tree.leaves), add_special_tokens=False).ids)


def test_language(spark, docs, rows):
    full = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = language.fit(full.where("doc_id % 2 = 0"))
    checked = language.identify(full.where("doc_id % 2 = 1"), model)
    right, n = checked.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.98 * n and checked.where("rejected").count() == 0
    got = language.predictions(docs.drop("lang_pred", "score")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (900, 901, 902):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[912].rejected and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    clashing = language.identify(docs, model)
    assert clashing.count() == len(rows) and clashing.columns.count("lang_pred") == 1


def test_texts_in_no_known_language_are_rejected_at_every_length(spark):
    common.ship(spark)
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(full.where("doc_id % 2 = 0"))
    others = [r.text for r in full.where("doc_id % 2 = 1").select("text").collect()]
    assert not any(model.predict(t)[2] for t in others)
    for n in (1, 2, 5, 20, 100):  # short texts of the known languages stay
        cut = [" ".join(t.split()[:n]) for t in others]
        assert sum(model.predict(t)[2] for t in cut) <= 0.01 * len(cut)
    random = np.random.default_rng(11)
    alphabets = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "".join(map(chr, range(0x430, 0x450))), "greek": "".join(map(chr, range(0x3B1, 0x3CA))), "han": "".join(map(chr, range(0x4E00, 0x5600))), "hangul": "".join(map(chr, range(0xAC00, 0xB400)))}
    for name, letters in alphabets.items():
        for n in (20, 50, 500, 1000, 5000) if name == "latin" else (1, 2, 50, 1000, 5000):
            text = " ".join("".join(random.choice(list(letters), random.integers(2, 9))) for _ in range(n))
            assert model.predict(text)[2], (name, n)


def test_copies_neither_fill_nor_empty_the_language_sample(spark):
    """Languages of few distinct texts in thousands of copies are known, whatever their hashes, and
    copies take one place only."""
    common.ship(spark)
    spell = lambda k, j: " ".join(chr(97 + (k * 7 + j + x * x) % 26) * 2 + chr(97 + (k * 5 + x) % 26) for x in range(30))
    texts = [(spell(k, j), f"lang{k}", 3000 // n) for k in range(12) for n in (1 + k % 3,) for j in range(n)]
    mixed = [(f"{spell(20, j)} {spell(20, j % 7)} number {'abcdefghij'[j % 10]}{'abcdefghij'[j // 10 % 10]}{'abcdefghij'[j // 100]}", "mixed", 1) for j in range(500)] + [(spell(20, 3), "mixed", 4000)]
    frame = spark.createDataFrame(texts + mixed, "text string, lang string, copies int").select("text", "lang", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).repartition(3)
    model = language.fit(frame)
    assert model.languages == sorted({*(f"lang{k}" for k in range(12)), "mixed"})
    assert all(model.predict(text)[0] == lang for text, lang, _ in texts)
    hashed = frame.select("lang", F.xxhash64("text").alias("h"))
    want = defaultdict(set)
    for r in hashed.distinct().collect():
        want[r.lang].add(r.h)
    got = defaultdict(list)
    for r in language.smallest_hashes(hashed, 20).collect():
        got[r.lang].append(r.h)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:20] for k, v in want.items()}


def test_decontamination(spark):
    item = [f"b{k}" for k in range(30)]
    other = [f"c{k}" for k in range(30)]
    noise = [f"n{k}" for k in range(50)]
    documents = spark.createDataFrame([
        (1, " ".join(noise + item + noise), "x"), (2, " ".join(item[15:] + noise + item[:15]).upper(), "x"), (3, " ".join(noise + item[:6] + noise), "x"),
        (4, " ".join(noise), "x"), (5, None, "x"), (6, "", "x"), (None, " ".join(item), "x"), (7, " ".join(item + item), "x"), (7, " ".join(item + item), "x"), (8, " ".join(other[:14] + ["gap"] + other[15:]), "x"),
    ], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(10, " ".join(item), "y"), (11, " ".join(other), "y"), (12, None, "y"), (13, "b1 b2", "y"), (14, "", "y")], "item_id long, text string, doc_id string")
    got = sorted((r.doc_id or 0, r.item_id, r.n_covered, r.contaminated) for r in decontaminate.contamination(documents, benchmark).collect())
    assert got == [(0, 10, 30, True), (1, 10, 30, True), (2, 10, 30, True), (3, 10, 6, False), (7, 10, 30, True), (7, 10, 30, True), (8, 11, 29, True)]
    kept = decontaminate.clean(documents, benchmark)
    assert kept.columns == documents.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_tiles_do_not_overlap():
    item, text = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], [6, 7, 8, 9, 10, 0, 1, 2, 3, 4, 5, 6, 7, 0, 1, 2, 3, 4, 5]
    found = decontaminate.tiles(item, text, 3)
    assert sorted(found, key=lambda t: -t[2])[0] == (0, 6, 7) and sum(k for _, _, k in found) == 10


def plain_tiling(item, text, shortest):
    """The longest run of free equal words again and again, found by comparing all places."""
    free_item, free_text, found = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                k = 0
                while a + k < len(item) and b + k < len(text) and item[a + k] == text[b + k] and free_item[a + k] and free_text[b + k]:
                    k += 1
                best = min(best, (-k, a, b))
        k, a, b = -best[0], *best[1:]
        if k < shortest:
            return found
        found.append((a, b, k))
        free_item[a : a + k] = [False] * k
        free_text[b : b + k] = [False] * k


def test_tiling_goes_on_with_what_a_longer_tile_left():
    item, text = list(range(20)), [*range(8), 100, *range(6, 15), 101, *range(8, 13)]
    assert sum(k for _, _, k in decontaminate.tiles(item, text, 5)) == 15
    random = np.random.default_rng(5)
    for _ in range(150):
        item = random.integers(0, 30, 24).tolist() if random.random() < 0.3 else list(range(24))
        text = []
        while len(text) < 40:
            a, n = random.integers(0, 20), random.integers(2, 14)
            text += item[a : a + n] + [-1] * int(random.integers(0, 2))
        assert decontaminate.tiles(item, text, 3) == plain_tiling(item, text, 3)


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="x">Home</a></li></ul></nav>
<div class="ad">Buy this now please</div><article><h1>Title &amp; more</h1><p>Words with <b>bold</b>text  in
a block that is long enough.<p>Second block.</article><div class="comments"><p>I like it</p></div><footer>&copy; somebody</footer>"""


def test_html(spark):
    pages = spark.read.parquet(f"{TABLES}/pages.parquet")
    weights = html_text.fit(pages)
    more = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "just &lt;text&gt;"), (1, "u", PAGE), (4, "u", "<p></p>"), (5, "u", PAGE.replace("article", "div"))], "page_id long, url string, html string")
    text = "Title & more Words with boldtext in a block that is long enough. Second block."
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(more.withColumn("text", F.lit("clash")), weights).collect()]
    assert Counter(got) == Counter([(1, text, len(text))] * 2 + [(2, "", 0), (3, "", 0), (None, "just <text>", 11), (4, "", 0), (5, text, len(text))])
    assert html_text.main_text(PAGE, html_text.Weights({})) == text
    for r in html_text.extract(pages, weights).join(pages.select("page_id", "html"), "page_id").collect():
        inside = r.html[r.html.index("<article>") : r.html.index("</article>")]
        start = html_text.unescape(inside[inside.index("<h1>") + 4 : inside.index("</h1>")])
        assert r.text.startswith(" ".join(start.split()))


WRAPPERS = ["has-sidebar", "no-sidebar", "layout-with-sidebar", "sticky-header", "comments-open", "search-results", "content-widget", "sidebar", "widget header"]


@pytest.mark.parametrize("weights", [html_text.Weights({}), html_text.Weights({"w body": (90, 10), "t p": (90, 10), "w article": (99, 0)})])
@pytest.mark.parametrize("names", WRAPPERS)
def test_names_of_wrappers_do_not_drop_the_article(names, weights):
    text = "Title & more Words with boldtext in a block that is long enough. Second block."
    wrapped = PAGE.replace("<body>", f'<body class="{names}">')
    assert html_text.main_text(wrapped, weights) == text
    assert html_text.main_text(PAGE.replace("<article>", f'<div class="{names}"><article>').replace("</article>", "</article></div>"), weights) == text
    # Without an article, most words decide.
    assert html_text.main_text(wrapped.replace("article", "div"), weights) == text


def test_names_of_parts_around_are_still_known():
    parts = ["site-footer", "sidebar-left", "ad-banner", "main_nav", "comments", "sidebar2", "related-posts"]
    assert all(html_text.names_around(f"x {part}") for part in parts) and not any(map(html_text.names_around, WRAPPERS[:7]))
    for part in parts:
        page = PAGE.replace('class="ad"', f'class="{part}"').replace('class="comments"', f'class="{part}"')
        assert html_text.main_text(page, html_text.Weights({})).endswith("enough. Second block.") and "Buy" not in html_text.main_text(page, html_text.Weights({}))


def test_a_template_on_few_pages_is_learned(spark):
    """No sample: 25 pages of one template among 3,000 others decide about its own elements."""
    common.ship(spark)
    page = "<body><article><p>some words of the text</p></article></body>"
    rare = '<body><article><p>some words of the text</p><div class="odd">these are no words of it</div></article><div class="tail">one two three four</div></body>'
    pages = spark.createDataFrame([(k, "u", rare if k % 120 == 0 else page) for k in range(3025)], "page_id long, url string, html string")
    learned = html_text.fit(pages).learned
    assert learned["w div.tail"] < 0.01 and learned["w div.odd"] > 0.99


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, id string")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    frames = [
        near_dedup.near_duplicates(none), language.predictions(none), substring_dedup.remove_repeats(none), decontaminate.contamination(none, items), decontaminate.clean(none, items),
        token_counts.count_tokens(none), fingerprints.fingerprints(none), packing.pack(none), line_dedup.remove_lines(none), html_text.extract(pages, html_text.fit(pages)), suffix_dedup.remove_repeats(none),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
