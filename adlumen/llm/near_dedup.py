"""Operator 1: MinHash near-dedup with min-max hashing.

Each document keeps, under every permutation of its shingle hashes, both the smallest and the
largest value, so ``PERMUTATIONS`` hash evaluations give twice as many signature values: each
agrees for two documents with the probability of their Jaccard similarity, and the two ends of one
permutation hardly depend on each other. ``ROWS`` values make a band; documents that agree in a
band are candidates, and candidates are confirmed on their full shingle sets. With 32 bands of 5
values a pair at a similarity of exactly 0.8 is missed with a probability of 3 in a million.

Large buckets are not paired out. Documents with equal sets are one class from the start. Every
bucket first compares its members with one pivot, the member that shares most buckets with others,
as the original of many edited copies does; what that links is joined to components. Only members of
different components in one bucket are left to compare. Where few are outside the bucket's largest
component, they are compared with all others. In the other buckets, prefix filtering finds the
components that a document outside can still belong to: a similar set holds one of its rarest
shingles. The members of such a component are compared with it in blocks, inside a task, so pairs
are never rows. Both steps are exact, so no link that would change a component is lost after the
bands.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from adlumen.llm import common as c
from adlumen.llm.components import components

PERMUTATIONS = 80
ROWS = 5
# So many members outside a bucket's largest component are compared with all others at once.
PATIENCE = 8
# Members of a component that are compared with a document in one row.
BLOCK = 64
# Bytes of shingle hashes that a task keeps for the texts it compares.
REMEMBERED = 32 << 20

_random = np.random.default_rng(7919)
_FACTOR = _random.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one after the other, and their ranges.

    A text with fewer than ``n`` words has its whole word sequence as the only shingle."""
    starts, ends, ranges = c.words(data, offsets)
    hashes = c.spans_hash(data, starts, ends)
    grams = c.grams_hash(hashes, n)
    sets = []
    for first, last in zip(ranges[:-1].tolist(), ranges[1:].tolist()):
        if last - first >= n:
            found = np.sort(grams[first : last - n + 1])
            sets.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        else:
            sets.append(c.grams_hash(hashes[first:last], last - first) if last > first else np.zeros(0, np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum([0, *map(len, sets)])


def min_max_bands(hashes: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """A row of band keys for each non-empty set."""
    starts = ranges[:-1]
    values = np.empty((len(starts), 2 * PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        permuted = hashes * _FACTOR[k] + _SHIFT[k]
        values[:, k] = np.minimum.reduceat(permuted, starts)
        values[:, PERMUTATIONS + k] = np.maximum.reduceat(permuted, starts)
    # The two ends of one permutation go to different bands.
    bands = values.reshape(len(starts), -1, ROWS)
    keys = np.zeros(bands.shape[:2], np.uint64)
    for k in range(ROWS):
        keys = c.mix(keys + bands[:, :, k])
    return c.mix(keys + np.arange(bands.shape[1], dtype=np.uint64))


SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signatures(texts: DataFrame, n: int) -> DataFrame:
    """``texts (id, text)`` to doc_id, n_shingles, a digest of the set and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            ids = one.column("id")
            offsets, data = c.bytes_column(one.column("text"))
            for first, last in c.chunks(offsets):
                at = offsets[first : last + 1] - offsets[first]
                hashes, ranges = shingle_hashes(c.lowered(data[offsets[first] : offsets[last]]), at, n)
                sizes = np.diff(ranges)
                some = sizes > 0
                keys = min_max_bands(hashes, np.append(ranges[:-1][some], len(hashes))).view(np.int64) if some.any() else np.zeros((0, 1), np.int64)
                digests = [blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist())]
                rows = iter(keys.tolist())
                yield c.batch({"doc_id": ids.slice(first, last - first), "n_shingles": sizes, "digest": digests, "bands": [next(rows) if s else None for s in some]}, SIGNED)

    return texts.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _remembered(n: int) -> Callable[[bytes], np.ndarray]:
    """The shingle hashes of a packed text; members of one bucket come again and again. As many are
    kept as fit into ``REMEMBERED`` bytes, the ones asked for last."""
    held: OrderedDict[bytes, np.ndarray] = OrderedDict()
    size = 0

    def hashes(packed: bytes) -> np.ndarray:
        nonlocal size
        found = held.get(packed)
        if found is not None:
            held.move_to_end(packed)
            return found
        data = np.frombuffer(c.decompress(packed), np.uint8)
        found = shingle_hashes(data, np.array([0, len(data)]), n)[0]
        held[packed] = found
        size += found.nbytes + len(packed)
        while size > REMEMBERED and len(held) > 1:
            old, gone = held.popitem(last=False)
            size -= gone.nbytes + len(old)
        return found

    return hashes


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    shared = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * shared >= percent * (len(small) + len(large) - shared)


def linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full shingle sets are similar; ``texts (id, packed)``."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("packed").alias("pa")), "a").join(texts.select(F.col("id").alias("b"), F.col("packed").alias("pb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _remembered(n)
        for one in batches:
            a, b = [], []
            for x, y, px, py in zip(*((x.as_py() for x in one.column(k)) for k in ("a", "b", "pa", "pb"))):
                if _similar(hashes(px), hashes(py), percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return both.select("a", "b", "pa", "pb").mapInArrow(run, "a long, b long")


def _near_size(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _across(rows: DataFrame, group: str, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rows (group, id, label, size, main)`` of one group with different labels. One
    of each pair is outside the largest label of the group, ``main``."""
    odd = rows.where("label <> main").select(group, F.col("id").alias("a"), F.col("label").alias("la"), F.col("size").alias("na"))
    others = rows.select(group, F.col("id").alias("b"), F.col("label").alias("lb"), F.col("size").alias("nb"), (F.col("label") == F.col("main")).alias("common"))
    return odd.join(others, group).where((F.col("la") != F.col("lb")) & (F.col("common") | (F.col("a") < F.col("b"))) & _near_size("na", "nb", percent)).select("a", "b").distinct()


def _open_components(rows: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (id, other) of a document of ``rows (id, label, size, lead)`` that leads and the label
    of another component that holds one of the shingles which a similar set must share with it: the
    rarest ``size - ceil(size * percent / 100) + 1`` in an order that is the same for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (piece for batch in batches for piece in c.bounded(batch, "packed")):
            ids, labels, sizes, found, times = [], [], [], [], []
            seen: dict[int, list[np.ndarray]] = {}
            for ident, label, lead, packed in zip(*(one.column(k).to_pylist() for k in ("id", "label", "lead", "packed"))):
                data = np.frombuffer(c.decompress(packed), np.uint8)
                hashes = shingle_hashes(data, np.array([0, len(data)]), n)[0].view(np.int64)
                if lead:
                    ids += [ident] * len(hashes)
                    labels += [label] * len(hashes)
                    sizes += [len(hashes)] * len(hashes)
                    found.append(hashes)
                    times.append(np.ones(len(hashes), np.int64))
                else:  # of the others only their component matters
                    seen.setdefault(label, []).append(hashes)
            for label, sets in seen.items():
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                ids += [None] * len(values)
                labels += [label] * len(values)
                sizes += [None] * len(values)
                found.append(values)
                times.append(counts)
            if found:
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (ids, labels, sizes)), pa.array(np.concatenate(found)), pa.array(np.concatenate(times))], ["id", "label", "size", "shingle", "times"])

    held = texts.join(rows.select("id", "label", "lead"), "id").select("id", "label", "lead", "packed")
    shingles = c.stored(held.mapInArrow(run, "id long, label long, size long, shingle long, times long"), "shingles")
    # Only shingles that several components hold can link them. All others come first in the order,
    # so they need no rank of their own.
    often = shingles.groupBy("shingle").agg(F.sum("times").alias("n"), (F.min("label") != F.max("label")).alias("meets")).where("meets").select("shingle", "n")
    of = Window.partitionBy("id")
    first = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    ranked = shingles.where("id is not null").join(often, "shingle").withColumn("rank", F.row_number().over(of.orderBy("n", "shingle"))).withColumn("shared", F.count("*").over(of))
    ranked = ranked.withColumn("asked", F.col("size") - F.col("shared") + F.col("rank") <= first)
    rare = c.stored(ranked.where("asked or rank = 1").select("shingle", "id", "label", "size", "shared", "asked"), "rare")
    # What a component can have in common with another document at most, and its least size.
    known = F.coalesce("shared", F.when(F.col("lead"), 0).otherwise(F.col("size")))
    bounds = rows.join(rare.select("id", "shared").distinct(), "id", "left").groupBy("label").agg(F.max(known).alias("most"), F.min("size").alias("least"))
    asked = rare.where("asked")
    holders = shingles.join(asked.select("shingle").distinct(), "shingle", "left_semi").select("shingle", "label").distinct().join(bounds, "label")
    # Labels that hold a shingle, about BLOCK in a row.
    spread = holders.groupBy("shingle").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    holders = holders.join(spread, "shingle").groupBy("shingle", F.pmod(F.xxhash64("label"), F.col("blocks")).alias("block")).agg(F.collect_list(F.struct("label", "most", "least")).alias("holders"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = asked.join(holders, "shingle").select("id", "label", "size", "shared", "holders").repartition(parts, "id")

    def able(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()  # as many as the task returns
        for one in batches:
            ids, labels, sizes, shared = (one.column(k).to_numpy() for k in ("id", "label", "size", "shared"))
            row = np.repeat(np.arange(len(ids)), one.column("holders").value_lengths().to_numpy())
            holder = pa.RecordBatch.from_struct_array(one.column("holders").flatten())
            other, most, least = (holder.column(k).to_numpy() for k in ("label", "most", "least"))
            common = np.minimum(shared[row], most)
            some = (other != labels[row]) & (common * 100 >= (sizes[row] + least - common) * percent)
            pairs = np.unique(np.stack([ids[row[some]], other[some]], axis=1), axis=0)
            new = [pair for pair in map(tuple, pairs.tolist()) if pair not in told]
            told.update(new)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in new], pa.int64()) for k in (0, 1)], ["id", "other"])

    return met.mapInArrow(able, "id long, other long")


def _linked_members(wanted: DataFrame, rows: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between each ``id`` of ``wanted (id, other)`` and members of the component."""
    blocks = rows.groupBy("label").agg(F.greatest(F.lit(1), F.floor(F.count("*") / BLOCK)).cast("int").alias("blocks"))
    members = rows.join(blocks, "label").join(texts, "id").select(F.col("label").alias("other"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "packed")
    members = members.groupBy("other", "block").agg(F.collect_list(F.struct("id", "packed")).alias("members"))
    asked = wanted.join(blocks.withColumnRenamed("label", "other"), "other").join(texts, "id")
    asked = asked.select(F.col("id").alias("a"), "packed", "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # Little data but much work: as many tasks as the session allows, whatever the bytes.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = asked.repartition(parts, "other", "block").join(members, ["other", "block"]).select("a", "packed", "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _remembered(n)
        for one in batches:
            a, b = [], []
            for x, packed, members in zip(*((x.as_py() for x in one.column(k)) for k in ("a", "packed", "members"))):
                found = [m["id"] for m in members if _similar(hashes(packed), hashes(m["packed"]), percent)]
                a += [x] * len(found)
                b += found
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def bucket_links(members: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Labels (v, label) of the components among ``members (key, id, size, weight)`` of buckets."""
    pivots = members.groupBy("key").agg(F.max(F.struct("weight", -F.col("id"), "size")).alias("p")).select("key", (-F.col("p.col2")).alias("pivot"), F.col("p.size").alias("pivot_size"))
    members = c.stored(members.join(pivots, "key"), "members")
    tried = members.where((F.col("id") != F.col("pivot")) & _near_size("size", "pivot_size", percent)).select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = c.stored(linked(tried, texts, n, percent), "links")
    labels = components(links)
    rest = members.where("id <> pivot").select("key", "id", "size").join(labels.select(F.col("v").alias("id"), "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    kinds = rest.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("members"), F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
    rest = c.stored(rest.join(kinds.select("key", F.col("top.label").alias("main"), (F.col("members") - F.col("top.n") <= PATIENCE).alias("few")), "key"), "rest")
    more = linked(_across(rest.where("few"), "key", percent), texts, n, percent)
    large = c.stored(rest.where("not few").groupBy("id", "label").agg(F.max("size").alias("size"), F.max(F.col("label") != F.col("main")).alias("lead")), "large")
    if not large.isEmpty():
        more = more.unionByName(_linked_members(_open_components(large, texts, n, percent), large.select("id", "label"), texts, n, percent))
    more = c.stored(more, "links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups of near duplicates: documents linked with 100 * |A and B| >= percent * |A or B|.

    Words are split at ASCII white space after A-Z became lower case; a document's set holds its
    distinct shingles of ``shingle`` words, or its whole word sequence if that is shorter. Returns
    one row for each input row: doc_id, n_shingles (long), component_id (the smallest doc_id that
    links reach), kept (doc_id = component_id).

    Null, empty and blank texts have no shingles, link with nothing and are kept. Rows without an id
    link with nothing: component_id and kept are null. Rows that share an id are one vertex, which
    has the links of all of them. An empty table gives an empty result; other columns are not read.
    """
    c.bound_batches(documents.sparkSession)
    texts = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = c.stored(signatures(texts, shingle), "signatures")
    usable = signed.where("doc_id is not null and digest is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("head"), F.max("n_shingles").alias("size"))
    classes = c.stored(classes, "classes")
    heads = usable.join(classes.select("digest", "head", "size"), "digest").where("doc_id = head")
    rows = heads.select(F.col("head").alias("id"), "size", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = c.stored(rows.join(buckets, "key"), "members")
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (piece for batch in batches for piece in c.bounded(batch)):
            some = [c.compress(b" ".join((x or "").encode().lower().split())) for x in one.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([one.column("id"), pa.array(some, pa.binary())], ["id", "packed"])

    wanted = weights.select("id")
    held = c.stored(texts.mapInArrow(packed, "id long, packed binary").join(wanted, "id", "left_semi"), "texts")
    labels = bucket_links(members.join(weights, "id").select("key", "id", "size", "weight"), held, shingle, percent)
    named = signed.join(classes.select("digest", "head"), "digest", "left").join(labels.select(F.col("v").alias("head"), "label"), "head", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "head", "doc_id"))
    return named.select("doc_id", "n_shingles", group.alias("component_id"), (F.col("doc_id") == group).alias("kept"))
