"""Candidate search shared by the two substring operators.

Both ask, for every window of ``width`` symbols (words or bytes), whether it also starts elsewhere.
Shipping every window would cost many times the corpus, so each window names one *anchor*: the
n-gram of ``gram`` symbols with the smallest hash inside it. Equal windows hold equal anchors at
equal places, so only windows whose anchor occurs twice need to be compared; this drops nothing.

1. ``anchors``: every task hashes its texts and sends each distinct anchor to the part of its hash.
   An anchor that a task has met before is known to be repeated and is sent to a part chosen by
   its place instead, so a passage found in a third of all documents loads no single task.
2. ``repeated``: a part sorts its anchors and reports those that occur more than once.
3. ``contexts``: the documents, joined with their repeated anchors, send the stretch of text that
   the windows of each such anchor cover to the part of the anchor. Windows of an anchor that very
   many tasks hold are sent one by one, to the part of the whole window.

What a part does with the stretches is the operator's own method.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlumen.llm import common as c

# An anchor that stands in so many places has its windows sent one by one.
CROWD = 256
# Bits that hold a place while hashes are compared: the same in every task, or ties would differ.
# A task's buffer is 1 MB or one text, so a text may have up to 2 ** 28 symbols.
PLACE_BITS = 28
DIGEST = 16
SALTS = 32


@dataclass(frozen=True)
class Shape:
    """Windows of ``width`` symbols, anchored by n-grams of ``gram`` symbols.

    ``anywhere``: a window counts as repeated if it starts in any other place; else only if it
    starts in a text with a smaller id.
    """

    by_words: bool
    width: int
    gram: int
    anywhere: bool
    # Ids differ by their higher bits; these lower ones tell the texts of one id apart.
    shared_bits: int = 0

    def later(self, ids: np.ndarray, than: np.ndarray) -> np.ndarray:
        return (ids >> self.shared_bits) > (than >> self.shared_bits)

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each symbol's n-gram, symbol starts, ends, and the symbol range of each text."""
        if self.by_words:
            starts, ends, ranges = c.words(data, offsets)
            return c.grams_hash(c.spans_hash(data, starts, ends), self.gram), starts, ends, ranges
        places = np.arange(len(data) - self.gram + 1) if len(data) >= self.gram else np.zeros(0, np.int64)
        starts = np.arange(len(data))
        return c.spans_hash(data, places, places + self.gram), starts, starts + 1, offsets

    def anchored(self, grams: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows inside one text, the place of the anchor of each, and the text of each."""
        span = self.width - self.gram + 1
        n = len(grams) - span + 1
        if n <= 0:
            return (np.zeros(0, np.int64),) * 3
        bits = np.uint64(PLACE_BITS)
        low = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while done * 2 <= span:
            low = np.minimum(low[: len(low) - done], low[done:])
            done *= 2
        if done < span:
            low = np.minimum(low[: len(low) - (span - done)], low[span - done :])
        counts = np.maximum(0, np.diff(ranges) - self.width + 1)
        texts = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        windows = np.arange(counts.sum()) - first[texts] + ranges[:-1][texts]
        return windows, (low[windows] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), texts


ANCHORS = pa.schema([("part", pa.int32()), ("known", pa.bool_()), ("hashes", pa.binary()), ("ids", pa.binary()), ("places", pa.binary()), ("counts", pa.binary())])
FOUND = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("place", pa.int32()), ("known", pa.bool_()), ("crowded", pa.bool_())])


def anchors(texts: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """Anchors of ``texts (id, text)``, packed by part."""

    def send(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        hashes, ids, places = (np.concatenate(x) for x in zip(*held))
        _, first, which, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        again = np.ones(len(hashes), bool)
        again[first] = False
        part = (hashes % np.uint64(parts)).astype(np.int32)
        part[again] = (c.mix(ids[again].astype(np.uint64) + np.uint64(1)) % np.uint64(parts)).astype(np.int32)
        rows = []
        for known in (False, True):
            of = np.flatnonzero(again == known)
            for number, places_of in c.by_part(part[of]):
                at = of[places_of]
                rows.append({"part": number, "known": known, "hashes": c.pack(hashes[at]), "ids": c.pack(ids[at]), "places": c.pack(places[at]), "counts": c.pack(counts[which[at]].astype(np.int32))})
        return c.batch({f.name: [r[f.name] for r in rows] for f in ANCHORS}, ANCHORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for one in batches:
            numbers = one.column("id").to_numpy(zero_copy_only=False)
            offsets, data = c.bytes_column(one.column("text"))
            for first, last in c.chunks(offsets):
                at = offsets[first : last + 1] - offsets[first]
                grams, _, _, ranges = shape.symbols(data[offsets[first] : offsets[last]], at)
                windows, place, owner = shape.anchored(grams, ranges)
                if not len(windows):
                    continue
                keep = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(owner) != 0)])
                place, owner = place[keep], owner[keep]
                held.append((grams[place], numbers[first:last][owner].astype(np.int64), (place - ranges[owner]).astype(np.int32)))
                size += len(place)
                if size > 1_000_000:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    return texts.mapInArrow(run, "part int, known boolean, hashes binary, ids binary, places binary, counts binary")


def repeated(packed: DataFrame, parts: int) -> DataFrame:
    """Rows (id, place, crowded) for each place of an anchor that occurs more than once."""

    def found(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray, known: bool, crowded: np.ndarray) -> pa.RecordBatch:
        return c.batch({"hash": hashes.view(np.int64), "id": ids, "place": places, "known": np.full(len(ids), known), "crowded": crowded}, FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for one in batches:
            for row in one.to_pylist():
                some = c.unpack(row["hashes"], np.uint64), c.unpack(row["ids"], np.int64), c.unpack(row["places"], np.int32), c.unpack(row["counts"], np.int32)
                if row["known"]:
                    yield found(*some[:3], True, np.zeros(len(some[0]), bool))
                else:
                    held.append(some)
        if held:
            h, i, p, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, i, p, n = h[order], i[order], p[order], n[order]
            edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            total = np.repeat(np.add.reduceat(n.astype(np.int64), edges), np.diff(np.append(edges, len(h))))
            keep = total > 1
            yield found(h[keep], i[keep], p[keep], False, total[keep] >= CROWD)

    rows = c.stored(packed.repartition(parts, "part").mapInArrow(run, "hash long, id long, place int, known boolean, crowded boolean"), "anchors")
    # Salted: one anchor may have a third of all rows.
    crowds = rows.where("crowded").select("hash").distinct().select("hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("crowd"))
    known = rows.where("known").select("hash", "id", "place", F.pmod(F.xxhash64("id", "place"), F.lit(SALTS)).cast("int").alias("salt"))
    later = known.join(crowds, ["hash", "salt"], "left").select("id", "place", F.coalesce("crowd", F.lit(False)).alias("crowded"))
    return rows.where("not known").select("id", "place", "crowded").unionByName(later)


@dataclass
class Stretches:
    """Stretches of text: windows of ``counts`` neighbouring starts each, and what they cover."""

    keys: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    texts: list[bytes]

    def __len__(self) -> int:
        return len(self.ids)


CONTEXTS = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()), ("starts", pa.binary()), ("counts", pa.binary()), ("flags", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary())])
CONTEXTS_SQL = "part int, keys binary, ids binary, starts binary, counts binary, flags binary, sizes binary, texts binary"
SPANS = "id long, start int, n int"


def document_stretches(shape: Shape, data: np.ndarray, ident: int, places: np.ndarray, crowded: np.ndarray) -> Stretches | None:
    """What one document has to send for its repeated anchors."""
    grams, starts, ends, ranges = shape.symbols(data, np.array([0, len(data)]))
    windows, anchor, _ = shape.anchored(grams, ranges)
    if not len(windows):
        return None
    state = np.zeros(len(grams), np.int8)
    state[places] = 1
    state[places[crowded]] = 2
    windows = windows[state[anchor] > 0]
    anchor = anchor[windows]
    if not len(windows):
        return None
    alone = state[anchor] == 2
    head = np.flatnonzero(np.concatenate([[True], (np.diff(windows) != 1) | (np.diff(anchor) != 0) | alone[1:]]))
    counts = np.diff(np.append(head, len(windows)))
    begin, keys = windows[head], grams[anchor[head]]
    single = alone[head]
    if single.any():
        at = begin[single]
        keys[single] = c.spans_hash(data, starts[at], ends[at + shape.width - 1])
    to = ends[begin + counts + shape.width - 2].tolist()
    raw = data.tobytes()
    if shape.by_words or not single.any():
        texts = [raw[a:b] for a, b in zip(starts[begin].tolist(), to)]
    else:  # a window of bytes on its own is longer than a digest of it that nobody can forge
        texts = [blake2b(raw[a:b], digest_size=DIGEST).digest() if one else raw[a:b] for a, b, one in zip(starts[begin].tolist(), to, single.tolist())]
    return Stretches(keys, np.full(len(head), ident, np.int64), begin.astype(np.int32), counts.astype(np.int32), texts)


def settled_here(some: Stretches, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Which stretches of a task need not be sent, as one sent with a smaller id (anywhere: any
    one) is equal, and which of all are repeated already."""
    which, counts = equal_places(some)
    order = np.lexsort((some.starts, some.ids, which))
    head = np.concatenate([[True], np.diff(which[order]) != 0])
    first = np.empty(len(some), np.int64)
    first[which[order[head]]] = order[head]
    first = first[which]
    if shape.anywhere:
        return first != np.arange(len(some)), counts > 1
    later = shape.later(some.ids, some.ids[first])
    return later, later


def contexts(joined: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """Stretches of ``joined (id, packed, places, crowds)``, packed by part.

    Stretches that are settled within the task go out as mere spans, to a part chosen by their
    document. Of documents that a batch holds several times, only one is taken apart.
    """

    def send(held: list[Stretches], whole: list[tuple[int, int]]) -> pa.RecordBatch:
        rows = []
        if whole:
            ids, n = np.array([x[0] for x in whole], np.int64), np.array([x[1] for x in whole], np.int32)
            for number, at in c.by_part((c.mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(parts)).astype(np.int32)):
                rows.append({"part": number, "keys": b"", "ids": c.pack(ids[at]), "starts": c.pack(np.zeros(len(at), np.int32)), "counts": c.pack(n[at]), "flags": c.pack(np.ones(len(at), bool)), "sizes": b"", "texts": b""})
        if held:
            some = Stretches(*(np.concatenate([getattr(x, k) for x in held]) for k in ("keys", "ids", "starts", "counts")), [t for x in held for t in x.texts])
            known, flags = settled_here(some, shape)
            part = (some.keys % np.uint64(parts)).astype(np.int32)
            part[known] = (c.mix(some.ids[known].astype(np.uint64) + np.uint64(1)) % np.uint64(parts)).astype(np.int32)
            for settled in (False, True):
                of = np.flatnonzero(known == settled)
                for number, places in c.by_part(part[of]):
                    at = of[places]
                    texts = [] if settled else [some.texts[x] for x in at.tolist()]
                    rows.append({
                        "part": number, "keys": b"" if settled else c.pack(some.keys[at]), "ids": c.pack(some.ids[at]), "starts": c.pack(some.starts[at]), "counts": c.pack(some.counts[at]),
                        "flags": c.pack(flags[at]), "sizes": b"" if settled else c.pack(np.array([len(x) for x in texts], np.int32)), "texts": c.compress(b"".join(texts)),
                    })
        return c.batch({f.name: [r[f.name] for r in rows] for f in CONTEXTS}, CONTEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Stretches] = []
        whole: list[tuple[int, int]] = []
        size = 0
        for one in batches:
            rows, seen = sorted(one.to_pylist(), key=lambda r: r["id"]), {}
            for row in rows:
                first = seen.setdefault(row["packed"], [row["id"], 0])
                if first[1] and (shape.anywhere or shape.later(row["id"], first[0])):
                    whole.append((row["id"], first[1]))
                    if shape.anywhere:
                        whole.append((first[0], first[1]))
                    continue
                data = np.frombuffer(c.decompress(row["packed"]), np.uint8)
                some = document_stretches(shape, data, row["id"], np.array(row["places"], np.int64), np.array(row["crowds"], bool))
                if some is None:
                    continue
                first[1] = (len(data) if not shape.by_words else len(data.tobytes().split())) - shape.width + 1
                held.append(some)
                size += sum(map(len, some.texts)) + 100 * len(some.texts)
                if size > 32 << 20:
                    yield send(held, whole)
                    held, whole, size = [], [], 0
        if held or whole:
            yield send(held, whole)

    return joined.mapInArrow(run, CONTEXTS_SQL)


def received(batches: Iterator[pa.RecordBatch]) -> tuple[Stretches, np.ndarray, list[pa.RecordBatch]]:
    """All stretches of a part with their flags, sorted by key; and the spans settled before."""
    some: list[tuple] = []
    texts: list[bytes] = []
    settled = []
    for one in batches:
        for row in one.to_pylist():
            ids, starts, counts = c.unpack(row["ids"], np.int64), c.unpack(row["starts"], np.int32), c.unpack(row["counts"], np.int32)
            if not row["keys"]:
                settled.append(spans_batch(ids, starts, counts))
                continue
            sizes, raw, at = c.unpack(row["sizes"], np.int32), c.decompress(row["texts"]), 0
            for size in sizes.tolist():
                texts.append(raw[at : at + size])
                at += size
            some.append((c.unpack(row["keys"], np.uint64), ids, starts, counts, c.unpack(row["flags"], np.bool_)))
    if not some:
        empty = np.zeros(0, np.int64)
        return Stretches(empty.view(np.uint64), empty, empty, empty, []), np.zeros(0, bool), settled
    keys, ids, starts, counts, flags = (np.concatenate(x) for x in zip(*some))
    order = np.argsort(keys, kind="stable")
    return Stretches(keys[order], ids[order], starts[order], counts[order], [texts[x] for x in order.tolist()]), flags[order], settled


def portions(some: Stretches, limit: int) -> Iterator[tuple[Stretches, slice]]:
    """Stretches with about ``limit`` windows at a time; those of one key stay together."""
    edges = np.append(np.flatnonzero(np.concatenate([[True], some.keys[1:] != some.keys[:-1]])), len(some))
    total = np.concatenate([[0], np.cumsum(some.counts)])[edges]
    first = 0
    while first < len(edges) - 1 and len(some):
        last = max(first + 1, int(np.searchsorted(total, total[first] + limit, "right")) - 1)
        of = slice(int(edges[first]), int(edges[last]))
        yield Stretches(some.keys[of], some.ids[of], some.starts[of], some.counts[of], some.texts[of]), of
        first = last


def equal_places(some: Stretches) -> tuple[np.ndarray, np.ndarray]:
    """A number for each stretch that is the same for equal ones, and how many are equal to it."""
    seen: dict[tuple[int, bytes], int] = {}
    which = np.array([seen.setdefault(k, len(seen)) for k in zip(some.keys.tolist(), some.texts)], np.int64)
    return which, np.bincount(which, minlength=1)[which] if len(which) else which


def spans_batch(ids: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(n, pa.int32())], ["id", "start", "n"])


def window_spans(ids: np.ndarray, owner: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows as spans of neighbouring starts. ``owner``: the stretch of each window, ascending,
    and ``start`` its place, ascending within a stretch; ``ids``: of the stretches."""
    head = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(start) != 1)])) if len(owner) else owner
    return spans_batch(ids[owner[head]], start[head], np.diff(np.append(head, len(owner))))


def search(texts: DataFrame, held: DataFrame, shape: Shape, parts: int, answer: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``held (id, packed)`` and the spans of repeated windows that ``answer`` finds: adds
    ``starts`` and ``ns``, null where there are none. Rows without an id take no part."""
    found = repeated(anchors(texts.where("id is not null and text is not null"), shape, parts), parts)
    found = found.groupBy("id").agg(F.collect_list("place").alias("places"), F.collect_list("crowded").alias("crowds"))
    sent = contexts(held.join(found, "id").select("id", "packed", "places", "crowds"), shape, parts)
    spans = sent.repartition(parts, "part").mapInArrow(answer, SPANS)
    return held.join(spans.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns")), "id", "left")


def covered(size: int, starts: list[int] | None, ns: list[int] | None, width: int) -> np.ndarray:
    """Which of ``size`` symbols the windows cover."""
    depth = np.zeros(size + 1, np.int32)
    if starts:
        at = np.array(starts, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, np.minimum(at + np.array(ns, np.int64) + width - 1, size), -1)
    return np.cumsum(depth[:-1]) > 0
