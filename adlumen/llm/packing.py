"""Operator 7: best-fit packing of documents into sequences by the linear grouping scheme.

Piece lengths are whole numbers up to the sequence length, so a histogram of at most ``CAPACITY``
rows describes any number of documents, and the plan is made from it alone:

1. Pieces longer than ``CAPACITY * SMALL`` are large. They are sorted by length and cut into
   ``GROUPS`` groups of equal cardinality; each is rounded up to the longest of its group, so only
   ``GROUPS`` sizes are left.
2. A fractional optimum over configurations (multisets of sizes that fit a sequence) is found by
   column generation: a knapsack over the dual prices proposes the next configuration. Whole
   multiples of the optimal configurations are used; what is left over is placed best-fit.
3. Actual lengths replace the rounded ones, longest first within a group, which leaves more room.
4. Small pieces go best-fit into the room that is left, then into new sequences.

Steps 3 and 4 work on kinds of sequences with multiplicities, never on single documents. The plan
gives every length ranges of ranks with their sequences; documents find theirs by their rank among
the pieces of their length, from counts per block of documents. Its size depends on ``CAPACITY``
and ``GROUPS`` only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from adlumen.llm import common as c
from adlumen.llm.tokens import encoder

CAPACITY = 1024
END = 2
SMALL = 0.45
GROUPS = 96


def grouped_sizes(counts: dict[int, int], groups: int) -> list[tuple[int, dict[int, int]]]:
    """Linear grouping: (rounded size, its actual lengths with counts), longest group first."""
    total = sum(counts.values())
    out: list[tuple[int, dict[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, {}))
                room = -(-total // groups)
            take = min(left, room)
            out[-1][1][length] = out[-1][1].get(length, 0) + take
            left -= take
            room -= take
    merged: dict[int, dict[int, int]] = {}
    for size, inside in out:
        into = merged.setdefault(size, {})
        for length, n in inside.items():
            into[length] = into.get(length, 0) + n
    return sorted(merged.items(), reverse=True)


def _best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits: an unbounded knapsack."""
    of = np.flatnonzero(prices > 1e-12)
    pattern = np.zeros(len(sizes), np.int64)
    if not len(of):
        return 0.0, pattern
    size, price = np.array(sizes)[of], prices[of]
    by = np.argsort(size)
    of, size, price = of[by], size[by], price[by]
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(size[0]), capacity + 1):
        fits = int(np.searchsorted(size, room, "right"))
        with_one = value[room - size[:fits]] + price[:fits]
        best = int(np.argmax(with_one))
        if with_one[best] > value[room - 1] + 1e-12:
            value[room], choice[room] = with_one[best], best
        else:
            value[room] = value[room - 1]
    room = capacity
    while room >= size[0]:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[of[choice[room]]] += 1
            room -= int(size[choice[room]])
    return float(value[capacity]), pattern


def fractional_plan(sizes: list[int], demand: list[int], capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Configurations with their fractional multiplicities, by the revised simplex method."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, pattern = _best_configuration(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        amounts, change = np.linalg.solve(basis, need), np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(change > 1e-9, amounts / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = pattern
    amounts = np.linalg.solve(basis, need)
    return [(basis[:, j].round().astype(np.int64), float(amounts[j])) for j in range(k)]


class _Bins:
    """Kinds of sequences: (room left, contents) with how many there are of each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)

    def put(self, contents: tuple[int, ...], n: int) -> None:
        kinds = self.by_room[self.capacity - sum(contents)]
        kinds[contents] = kinds.get(contents, 0) + n

    def best_fit(self, length: int, n: int) -> None:
        """Places ``n`` pieces of one length where the least room is left, or in new sequences."""
        for room in sorted(r for r in self.by_room if r >= length):
            kinds = self.by_room[room]
            for contents in sorted(kinds):
                if not n:
                    break
                have = kinds[contents]
                each = min(room // length, -(-n // have))
                used = min(have, n // each)
                if used < have:
                    kinds[contents] = have - used
                else:
                    del kinds[contents]
                if used:
                    self.put(contents + (length,) * each, used)
                    n -= used * each
            if not kinds:
                del self.by_room[room]
        each = self.capacity // length
        if n >= each:
            self.put((length,) * each, n // each)
        if n % each:
            self.put((length,) * (n % each), 1)


def _take(stock: list[list[list[int]]], pattern: np.ndarray, times: int) -> tuple[tuple[int, ...], int]:
    """Fills up to ``times`` sequences of a pattern with equal actual lengths, the longest that each
    group has left, and takes them off the stock. No sequences if a group has too few."""
    wanted = [(i, int(pattern[i])) for i in np.flatnonzero(pattern).tolist()]
    if any(sum(n for _, n in stock[i]) < need for i, need in wanted):
        return (), 0
    whole = all(stock[i][-1][1] >= need for i, need in wanted)
    same = min(times, *(stock[i][-1][1] // need for i, need in wanted)) if whole else 1
    contents: list[int] = []
    for i, need in wanted:
        while need:
            length, n = stock[i][-1]
            each = min(need, n)
            contents += [length] * each
            need -= each
            stock[i][-1][1] -= each * same
            if not stock[i][-1][1]:
                stock[i].pop()
    return tuple(contents), same


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: float = SMALL) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences, each a tuple of lengths, with multiplicities that use up ``counts``."""
    bins = _Bins(capacity)
    counts = {length: n for length, n in counts.items() if n}
    if full := counts.pop(capacity, 0):
        bins.put((capacity,), full)
    large = {length: n for length, n in counts.items() if length > capacity * small}
    if large:
        classes = grouped_sizes(large, groups)
        stock = [[list(x) for x in sorted(inside.items())] for _, inside in classes]
        for pattern, amount in fractional_plan([size for size, _ in classes], [sum(inside.values()) for _, inside in classes], capacity):
            times = int(amount + 1e-9)
            while times > 0:
                contents, same = _take(stock, pattern, times)
                if not same:
                    break
                bins.put(contents, same)
                times -= same
        for length, n in sorted(((length, n) for s in stock for length, n in s), reverse=True):
            bins.best_fit(length, n)
    for length in sorted((x for x in counts if x <= capacity * small), reverse=True):
        bins.best_fit(length, counts[length])
    return [(contents, n) for room in sorted(bins.by_room) for contents, n in sorted(bins.by_room[room].items())]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: the first rank of each range of ranks, and the sequence and offset of that
    first one; the ranks after it are in the sequences after it, at the same offset."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    rank: dict[int, int] = defaultdict(int)
    sequence = 0
    for contents, n in plan:
        offset = 0
        for length in contents:
            found[length].append((rank[length], sequence, offset))
            rank[length] += n
            offset += length
        sequence += n
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows)) for length, rows in found.items()}


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("block", pa.int64()), ("nth", pa.int64())])


def pieces(texts: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """The pieces of ``texts (id, text)``. A task's pieces are a block; ``nth`` counts those of one
    length in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = END.to_bytes(4, "little")
        block = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for one in batches:
            rows = []
            for ident, text in zip(one.column("id").to_pylist(), one.column("text").to_pylist()):
                ids = memoryview(encode(text or "") + end)
                n, at, number = len(ids) // 4, 0, 0
                while at < n:
                    to = at + ((n - at) % capacity or capacity)
                    rows.append((ident, number, at, to - at, crc32(ids[4 * at : 4 * to]), block, seen[to - at]))
                    seen[to - at] += 1
                    at, number = to, number + 1
            yield c.batch(dict(zip(PIECES.names, map(list, zip(*rows)))) if rows else {k: [] for k in PIECES.names}, PIECES)

    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, block long, nth long")


def pack(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """Token pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    A document's ids are those of its text and then id 2. Only longer ones are cut, into pieces of
    ``capacity``, of which the first may be shorter. Returns one row for each piece: doc_id, piece
    (int), start, length, ids_crc32, sequence_id, offset (long).

    A null text is empty and gives one piece with id 2 alone. Each input row is packed, also rows
    repeated or without an id. An empty table gives an empty result; other columns are not read.
    """
    texts = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    # Stored, so that all later passes see the same blocks and places in them.
    made = c.stored(pieces(texts, vocabulary, capacity), "pieces")
    counts = made.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = made.groupBy("length").count().collect()  # at most ``capacity`` rows
    places = documents.sparkSession.sparkContext.broadcast(slots(packing_plan({r[0]: r[1] for r in histogram}, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            length, rank = one.column("length").to_numpy(), one.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length).tolist():
                of = np.flatnonzero(length == value)
                first, at, offsets = places.value[value]
                which = np.searchsorted(first, rank[of], "right") - 1
                sequence[of], offset[of] = at[which] + rank[of] - first[which], offsets[which]
            yield pa.RecordBatch.from_arrays([*(one.column(k) for k in PIECES.names[:5]), pa.array(sequence), pa.array(offset)], [*PIECES.names[:5], "sequence_id", "offset"])

    ranked = made.join(bases, ["length", "block"]).select(*PIECES.names[:5], (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
