"""Operator 10: exact substring dedup with a hash-compared suffix sort over bytes.

Every position whose 200-byte window may repeat (see ``repeats``) is a suffix. A part sorts its
suffixes by mergesort. Two suffixes are compared through polynomial prefix hashes: binary search
for their longest common extension takes a logarithmic number of hash comparisons, and the byte
after it decides. All merges of one level run together as array operations: an element's place in
the merged run is its rank in its own run plus its rank in the sibling run, found by binary search.
Neighbours in sorted order that agree in all bytes of a window are verified byte by byte; should a
hash collision show, the group is sorted by its bytes instead.

Suffixes under different anchors or at different distances from it cannot share a window, so they
are sorted as separate segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlumen.llm import common as c, repeats as r

WIDTH = 200
GRAM = 40
# Suffixes that are sorted at once.
SUFFIXES = 500_000
_BASE = 0xD6E8FEB86659FD93


class Extensions:
    """Longest common extensions in one buffer by prefix hashes and binary search."""

    def __init__(self, data: np.ndarray, width: int):
        self.data, self.width = data, width
        self.power = c.powers(_BASE, len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:-1], out=self.total[1:])

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes, up to the window's width, that the suffixes at x and y have in common."""
        far = np.maximum(x, y)
        up_x, up_y = self.power[far - x], self.power[far - y]
        from_x, from_y = self.total[x], self.total[y]
        low = np.zeros(len(x), np.int64)
        step = 1 << (self.width.bit_length() - 1)
        while step:
            to = low + step
            ok = to <= self.width
            to = np.where(ok, to, low)
            ok &= (self.total[x + to] - from_x) * up_x == (self.total[y + to] - from_y) * up_y
            low = np.where(ok, to, low)
            step >>= 1
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at x comes before that at y; equal ones where ``or_equal``."""
        n = self.common(x, y)
        end = n >= self.width
        n = np.where(end, 0, n)
        return np.where(end, or_equal, self.data[x + n] < self.data[y + n])


def suffix_sort(ext: Extensions, places: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """The order that sorts ``places`` by suffix within each segment; ``segment`` is ascending."""
    n = len(places)
    order = np.arange(n)
    head = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0])) if n else order
    size = np.diff(np.append(head, n))
    begin, length = np.repeat(head, size), np.repeat(size, size)
    run = 1
    active = np.flatnonzero(length > 1)
    while len(active):
        first, count = begin[active], length[active]
        at = active - first
        block = at // run
        sibling = (block ^ 1) * run
        low = np.minimum(sibling, count)
        high = np.minimum(sibling + run, count)
        left = (block & 1) == 0
        lo, hi = low.copy(), high.copy()
        mine = places[order[active]]
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            other = places[order[first[todo] + mid]]
            # Stable: an equal element of the left run comes first.
            before = ext.less(other, mine[todo], ~left[todo])
            lo[todo] = np.where(before, mid + 1, lo[todo])
            hi[todo] = np.where(before, hi[todo], mid)
            todo = todo[lo[todo] < hi[todo]]
        moved = first + np.minimum(block & ~1, block) * run + (at - block * run) + (lo - low)
        merged = order.copy()
        merged[moved] = order[active]
        order = merged
        run *= 2
        active = active[length[active] > run]
    return order


def same_bytes(data: np.ndarray, x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Whether the windows at x and y are equal, byte by byte."""
    windows = np.lib.stride_tricks.sliding_window_view(data, width)
    out = np.ones(len(x), bool)
    for first in range(0, len(x), 50_000):
        of = slice(first, first + 50_000)
        out[of] = (windows[x[of]] == windows[y[of]]).all(axis=1)
    return out


def repeated_suffixes(texts: list[bytes], keys: np.ndarray, counts: np.ndarray, twin: np.ndarray, width: int, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that occur more than once among the stretches: their stretch and their place in it.

    ``twin``: stretches that have an equal one elsewhere. ``lead``: where a stretch's anchor stands.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(counts.sum()) - (np.cumsum(counts) - counts)[owner]
    places = (np.cumsum(sizes) - sizes)[owner] + inner
    distance = lead[owner] - inner
    by = np.lexsort((distance, keys[owner]))
    changes = (np.diff(keys[owner][by]) != 0) | (np.diff(distance[by]) != 0)
    segment = np.concatenate([[0], np.cumsum(changes)])
    ext = Extensions(data, width)
    order = by[suffix_sort(ext, places[by], segment)]
    ranked = places[order]
    close = np.flatnonzero(np.diff(segment) == 0)
    close = close[ext.common(ranked[close], ranked[close + 1]) >= width]
    if not same_bytes(data, ranked[close], ranked[close + 1], width).all():
        windows = np.lib.stride_tricks.sliding_window_view(data, width)
        raw = np.array([windows[p].tobytes() for p in places], dtype=object)
        _, which, n = np.unique(raw, return_inverse=True, return_counts=True)
        hit = n[which] > 1
    else:
        hit = np.zeros(len(places), bool)
        hit[order[close]] = True
        hit[order[close + 1]] = True
    hit |= twin[owner]
    return owner[hit], inner[hit]


def repeated_windows(batches: Iterator[pa.RecordBatch], shape: r.Shape) -> Iterator[pa.RecordBatch]:
    some, flags, settled = r.received(batches)
    yield from settled
    for portion, of in r.portions(some, SUFFIXES):
        which, n = r.equal_places(portion)
        # A set flag means that the sending task had an equal stretch besides.
        twin = (n > 1) | flags[of]
        # Of equal stretches one stands for all in the sort.
        first = np.zeros(len(portion), bool)
        first[np.unique(which, return_index=True)[1]] = True
        whole = np.array([len(t) for t in portion.texts]) >= shape.width
        yield r.window_spans(portion.ids, *_windows_of(portion, np.flatnonzero(twin)))
        sort = np.flatnonzero(first & whole)
        crowded = np.bincount(np.unique(portion.keys[sort], return_inverse=True)[1], minlength=1)
        sort = sort[crowded[np.unique(portion.keys[sort], return_inverse=True)[1]] > 1] if len(sort) else sort
        if not len(sort):
            continue
        texts = [portion.texts[x] for x in sort.tolist()]
        owner, inner = repeated_suffixes(texts, portion.keys[sort], portion.counts[sort], np.zeros(len(sort), bool), shape.width, _lead(texts, portion.keys[sort], shape))
        # What holds for one stretch holds for all equal to it.
        group = {int(which[s]): k for k, s in enumerate(sort.tolist())}
        like = np.array([group.get(int(w), -1) for w in which])
        edges = np.searchsorted(owner, np.arange(len(sort) + 1))
        for member in np.flatnonzero((like >= 0) & ~twin).tolist():
            k = like[member]
            places = inner[edges[k] : edges[k + 1]]
            if len(places):
                yield r.window_spans(portion.ids, np.full(len(places), member), portion.starts[member] + places)


def _windows_of(some: r.Stretches, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(chosen, some.counts[chosen])
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(some.counts[chosen]) - some.counts[chosen], some.counts[chosen])
    return owner, some.starts[owner] + inner


def _lead(texts: list[bytes], keys: np.ndarray, shape: r.Shape) -> np.ndarray:
    """Where the anchor stands in each stretch: the leftmost n-gram with the key's hash."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(max(0, len(data) - shape.gram + 1))
    grams = c.spans_hash(data, at, at + shape.gram)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(grams)]
    match = np.flatnonzero((grams == keys[owner]) & (at + shape.gram <= (starts + sizes)[owner]))
    out = np.zeros(len(texts), np.int64)
    owners, first = np.unique(owner[match], return_index=True)
    out[owners] = match[first] - starts[owners]
    return out


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(documents: DataFrame, doc_id: str | Column = "doc_id", text: str | Column = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Documents without the bytes that any ``width``-byte string which also starts elsewhere covers.

    Elsewhere is any other place of the same or another document; matches may overlap, do not cross
    documents, and are judged on the input. Returns one row for each input row: doc_id, n_bytes,
    n_removed, n_spans (long: maximal removed runs), kept (binary: the remaining bytes).

    Null and empty texts have no bytes: zeros and an empty value. Texts shorter than ``width`` stay
    whole. Rows that share an id are texts of their own, and repeated rows places of their own, so repeated rows lose all that
    ``width`` bytes reach. Rows without an id are returned whole and take no part. An empty table
    gives an empty result; other columns, whatever their names, are not read.
    """
    shape = r.Shape(False, width, gram, True)
    texts = documents.select((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("long").alias("id"), (F.col(text) if isinstance(text, str) else text).alias("text"))

    texts, names, _ = c.told_apart(texts)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            yield pa.RecordBatch.from_arrays([one.column("id"), pa.array([c.compress((x or "").encode()) for x in one.column("text").to_pylist()], pa.binary())], ["id", "packed"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            rows = []
            for row in one.to_pylist():
                data = np.frombuffer(c.decompress(row["packed"]), np.uint8)
                gone = r.covered(len(data), row["starts"], row["ns"], width)
                spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                rows.append((row["id"], len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    parts = c.parts_for(texts, "text")
    found = r.search(texts, texts.mapInArrow(packed, "id long, packed binary"), shape, parts, lambda batches: repeated_windows(batches, shape))
    return c.named(found.mapInArrow(keep, KEPT), names)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
