"""Operator 8: line dedup by a deletion-neighbourhood join.

Two lines are the same if their edit distance is at most one, lines of fewer than ``MIN_CHARS``
characters only if they are equal. Equal lines are one class, found by a digest. For the first line
of each class:

1. One edit leaves a line's first or second half as it is, so lines that share neither half (with
   the length) with another class are settled. The others are candidates.
2. A candidate emits every variant with one character deleted, as a hashed key, and itself. Lines
   that share a variant with the deletion at the same place differ by a substitution; a line that
   equals a variant differs by an insertion or deletion. Per key only the earliest line of either
   kind matters, so no group is paired out.
3. Joined lines are verified by their edit distance.

A line goes if an earlier line, by doc_id and place, is the same. Variants travel packed by hash
part, so that a part fits in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlumen.llm import common as c

MIN_CHARS = 24
# Half-line keys up to this count are broadcast; beyond it the join is shuffled.
BROADCAST_ROWS = 200_000
# Variants a task holds before it sends them.
HELD = 300_000

LINES = pa.schema([("digest", pa.binary()), ("id", pa.int64()), ("line", pa.int32()), ("halves", pa.list_(pa.int64()))])
_BASE = 0xA0761D6478BD642F
_UNBASE = pow(_BASE, -1, 1 << 64)


def _digest(data: bytes, size: int = 16) -> bytes:
    return blake2b(data, digest_size=size).digest()


def half_keys(line: str) -> list[int]:
    """Keys of which two lines within one edit share one: halves for either length of the shorter."""
    out = []
    for short in (len(line), len(line) - 1):
        front = short // 2
        for side, part in (("<", line[:front]), (">", line[len(line) - (short - front) :])):
            out.append(int.from_bytes(_digest(f"{side}{short} {part}".encode(), 8), "little", signed=True))
    return out


def variant_hashes(line: str) -> tuple[np.ndarray, np.uint64]:
    """Hashes of the line without each one of its characters, and of the line itself."""
    codes = c.mix(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * c.powers(_BASE, len(codes)), out=total[1:])
    return c.mix(total[:-1] + (total[-1] - total[1:]) * np.uint64(_UNBASE)), c.mix(total[-1:])[0]


def lines_of(texts: DataFrame, min_chars: int) -> DataFrame:
    """The lines that are not blank of ``texts (id, text)``: digest, id, line and half keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (piece for batch in batches for piece in c.bounded(batch)):
            digests, ids, numbers, halves = [], [], [], []
            for ident, text in zip(one.column("id").to_pylist(), one.column("text").to_pylist()):
                for number, line in enumerate(text.split("\n")):
                    if line := line.strip():
                        digests.append(_digest(line.encode()))
                        ids.append(ident)
                        numbers.append(number)
                        halves.append(half_keys(line) if len(line) >= min_chars else [])
            yield c.batch({"digest": digests, "id": ids, "line": numbers, "halves": halves}, LINES)

    return texts.mapInArrow(run, "digest binary, id long, line int, halves array<long>")


PACKED = "part int, hashes binary, ids binary, lines binary, places binary"
MET = pa.schema([("id", pa.int64()), ("line", pa.int32()), ("id2", pa.int64()), ("line2", pa.int32())])


def variants(candidates: DataFrame, parts: int) -> DataFrame:
    """Variant keys of ``candidates (id, line, text)``, packed by hash part. The place is that of
    the deleted character, -1 for the line itself."""

    def send(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        hashes, ids, lines, places = (np.concatenate(x) for x in zip(*held))
        rows = [(number, c.pack(hashes[at]), c.pack(ids[at]), c.pack(lines[at]), c.pack(places[at])) for number, at in c.by_part((hashes % np.uint64(parts)).astype(np.int32))]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), kinds)], ["part", "hashes", "ids", "lines", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in (piece for batch in batches for piece in c.bounded(batch)):
            for row in one.to_pylist():
                without, whole = variant_hashes(row["text"])
                n = len(without) + 1
                held.append((np.append(without, whole), np.full(n, row["id"]), np.full(n, row["line"], np.int32), np.append(np.arange(n - 1), -1).astype(np.int32)))
                size += n
                if size > HELD:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    return candidates.mapInArrow(run, PACKED)


def meetings(packed: DataFrame, parts: int) -> DataFrame:
    """Pairs (id, line) and an earlier (id2, line2) that share a key; the earliest of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for one in batches:
            for row in one.to_pylist():
                held.append(tuple(c.unpack(row[k], t) for k, t in (("hashes", np.uint64), ("ids", np.int64), ("lines", np.int32), ("places", np.int32))))
        if not held:
            return
        h, i, n, p = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((n, i, p, h))
        h, i, n, p = h[order], i[order], n[order], p[order]
        key = np.concatenate([[True], h[1:] != h[:-1]])
        kind = key | np.concatenate([[True], p[1:] != p[:-1]])
        # Same variant, same place: all but the earliest meet the earliest.
        first = np.maximum.accumulate(np.where(kind, np.arange(len(h)), 0))
        later = np.flatnonzero((p >= 0) & (first != np.arange(len(h))))
        pairs = [(i[later], n[later], i[first[later]], n[first[later]])]
        # A line that is the variant of others meets the earliest of them, and they meet it.
        own = np.flatnonzero(key & (p == -1))
        group = np.cumsum(key) - 1
        start = np.flatnonzero(key)
        itself = np.full(len(start), -1)
        itself[group[own]] = own
        other = np.flatnonzero((p >= 0) & (itself[group] >= 0))
        whole = itself[group[other]]
        before = (i[whole] < i[other]) | ((i[whole] == i[other]) & (n[whole] < n[other]))
        a, b = other[before], whole[before]
        pairs.append((i[a], n[a], i[b], n[b]))
        a, b = whole[~before], other[~before]
        if len(a):  # of the earlier ones, the earliest for each line
            by = np.lexsort((n[b], i[b], a))
            head = by[np.concatenate([[True], np.diff(a[by]) != 0])]
            pairs.append((i[a[head]], n[a[head]], i[b[head]], n[b[head]]))
        out = [np.concatenate(x) for x in zip(*pairs)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(out, MET)], schema=MET)

    return packed.repartition(parts, "part").mapInArrow(run, "id long, line int, id2 long, line2 int").distinct()


def dropped_lines(texts: DataFrame, held: DataFrame, parts: int, min_chars: int) -> DataFrame:
    """(id, line) of every line with an earlier one that is the same. ``held (id, packed)``."""
    lines = c.stored(lines_of(texts, min_chars), "lines")
    classes = lines.groupBy("digest").agg(F.min(F.struct("id", "line")).alias("first"), F.count("*").alias("n"))
    repeats = lines.join(classes.where("n > 1").select("digest", "first"), "digest").where("id <> first.id or line <> first.line").select("id", "line")
    # Halves that two different first lines share; equal lines share all of theirs.
    halves = lines.where(F.size("halves") > 0).select(F.xxhash64("digest").alias("d"), "id", "line", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where("lo <> hi").select("half")
    shared = c.stored(shared, "halves")
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    near = halves.join(shared, "half").groupBy("d").agg(F.min(F.struct("id", "line")).alias("first")).select("first.id", "first.line")
    near = near.groupBy("id").agg(F.collect_list("line").alias("lines"))  # of one document each

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (piece for batch in batches for piece in c.bounded(batch, "packed")):
            ids, numbers, found = [], [], []
            for row in one.to_pylist():
                all_lines = c.decompress(row["packed"]).decode().split("\n")
                for number in row["lines"]:
                    ids.append(row["id"])
                    numbers.append(number)
                    found.append(all_lines[number].strip())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(found, pa.string())], ["id", "line", "text"])

    candidates = c.stored(held.join(near, "id").select("id", "packed", "lines").mapInArrow(pick, "id long, line int, text string"), "candidates")
    met = meetings(variants(candidates, parts), parts)
    earlier = candidates.select(F.col("id").alias("id2"), F.col("line").alias("line2"), F.col("text").alias("text2"))
    near_lines = met.join(candidates, ["id", "line"]).join(earlier, ["id2", "line2"]).where(F.levenshtein("text", "text2") <= 1).select("id", "line")
    return repeats.unionByName(near_lines)


def remove_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, carry: list[str] | None = None) -> DataFrame:
    """Documents without the lines that an earlier line of the corpus is the same as.

    Lines end at line feeds and are compared without white space at their ends; blank ones always
    stay. Lines come in the order of doc_id and place. Returns one row for each input row: doc_id,
    n_lines, n_removed (long: lines that are not blank), kept (string: the other lines as they
    stood, joined by line feeds), and ``carried``, a struct of the columns named in ``carry``.

    A null text is empty and has no lines. Rows that share an id are texts of their own, in the order of a hash of
    them; a row repeated with the same text has the same lines, which are no earlier ones. Rows without an id are returned whole and take no part. An empty table
    gives an empty result; other columns are not read.
    """
    carried = F.struct(*(F.col("`" + k.replace("`", "``") + "`") for k in carry)) if carry else F.struct(F.lit(True).alias("_"))
    texts = documents.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), carried.alias("carried"))
    texts, names, _ = c.told_apart(texts)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (piece for batch in batches for piece in c.bounded(batch)):
            yield pa.RecordBatch.from_arrays([one.column("id"), pa.array([c.compress(x.encode()) for x in one.column("text").to_pylist()], pa.binary()), one.column("carried")], ["id", "packed", "carried"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (piece for batch in batches for piece in c.bounded(batch, "packed")):
            n_lines, n_removed, kept = [], [], []
            for raw, numbers in zip(one.column("packed").to_pylist(), one.column("lines").to_pylist()):
                lines, gone = c.decompress(raw).decode().split("\n"), set(numbers or ())
                n_lines.append(sum(bool(x.strip()) for x in lines))
                n_removed.append(len(gone))
                kept.append("\n".join(x for k, x in enumerate(lines) if k not in gone))
            counts = [pa.array(x, pa.int64()) for x in (n_lines, n_removed)]
            yield pa.RecordBatch.from_arrays([one.column("id"), *counts, pa.array(kept, pa.string()), one.column("carried")], ["doc_id", "n_lines", "n_removed", "kept", "carried"])

    carried = T.StructField("carried", texts.schema["carried"].dataType)
    held = texts.mapInArrow(packed, T.StructType([T.StructField("id", T.LongType()), T.StructField("packed", T.BinaryType()), carried]))
    gone = dropped_lines(texts.where("id is not null and text <> ''").select("id", "text"), held, c.parts_for(texts, "text"), min_chars)
    gone = gone.groupBy("id").agg(F.collect_set("line").alias("lines"))
    schema = T.StructType([*(T.StructField(k, T.LongType()) for k in ("doc_id", "n_lines", "n_removed")), T.StructField("kept", T.StringType()), carried])
    result = held.join(gone, "id", "left").mapInArrow(keep, schema)
    result = c.named(result, names)
    return result if carry else result.drop("carried")
