"""Operator 4: benchmark decontamination by greedy string tiling.

Shared seeds, runs of ``SEED`` words, join documents with benchmark items. Each pair found so is
tiled: running Karp-Rabin hashes of falling length find the longest common runs of words that are
not marked yet, and these are marked, longest first, without overlap. The share of an item's words
under tiles is its coverage; the order of tiles does not matter, so reordered passages are caught.

The benchmark is collected and broadcast in blocks of at most ``BLOCK_BYTES`` of text, each against
all documents, so its size is not assumed. Documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlumen.llm import common as c

SEED = 5
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _rolling(tokens: list[int], free: list[bool], n: int) -> Iterator[tuple[int, int]]:
    """Place and Karp-Rabin hash of each run of ``n`` unmarked tokens."""
    top = pow(_BASE, n - 1, _PRIME)
    value = length = 0
    for i, token in enumerate(tokens):
        if not free[i]:
            value = length = 0
            continue
        if length == n:
            value = (value - tokens[i - n] * top) % _PRIME
            length -= 1
        value = (value * _BASE + token) % _PRIME
        length += 1
        if length == n:
            yield i - n + 1, value


def tiles(item: list[int], text: list[int], shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length) of non-overlapping tiles."""
    free_item, free_text = [True] * len(item), [True] * len(text)
    found = []
    n = min(len(item), len(text))
    while n >= shortest:
        runs: dict[int, list[int]] = defaultdict(list)
        for place, value in _rolling(text, free_text, n):
            runs[value].append(place)
        matches = []
        for a, value in _rolling(item, free_item, n):
            for b in runs.get(value, ()):
                if item[a : a + n] != text[b : b + n]:
                    continue
                if a and b and item[a - 1] == text[b - 1] and free_item[a - 1] and free_text[b - 1]:
                    continue  # a part of the run that starts before it
                k = n
                while a + k < len(item) and b + k < len(text) and item[a + k] == text[b + k] and free_item[a + k] and free_text[b + k]:
                    k += 1
                matches.append((-k, a, b))
        heapify(matches)
        while matches:
            k, a, b = heappop(matches)
            free = [x and y for x, y in zip(free_item[a : a - k], free_text[b : b - k])]
            if all(free):
                found.append((a, b, -k))
                free_item[a : a - k] = [False] * -k
                free_text[b : b - k] = [False] * -k
                continue
            # What a longer tile has left of a run takes its place among the others by its length.
            first = 0
            for end in [i for i, x in enumerate(free) if not x] + [-k]:
                if end - first >= n:
                    heappush(matches, (first - end, a + first, b + first))
                first = end + 1
        # Rests that are shorter than this length are found again at a smaller one.
        n = n // 2 if n // 2 > shortest else (shortest if n > shortest else 0)
    return found


class Block:
    """A part of the benchmark with its seeds."""

    def __init__(self, rows: list[tuple[int, str]], seed: int):
        self.ids = [r[0] for r in rows]
        raw = [b" ".join(r[1].encode().lower().split()) for r in rows]
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts, ends, ranges = c.words(data, np.cumsum([0, *map(len, raw)]))
        hashes = c.spans_hash(data, starts, ends)
        grams = c.grams_hash(hashes, seed)
        self.words = [hashes[a:b].tolist() for a, b in zip(ranges[:-1], ranges[1:])]
        counts = np.maximum(0, np.diff(ranges) - seed + 1)
        owner = np.repeat(np.arange(len(rows)), counts)
        place = np.arange(counts.sum()) - (np.cumsum(counts) - counts)[owner] + ranges[:-1][owner]
        order = np.argsort(grams[place], kind="stable")
        self.seeds, self.owner = grams[place][order], owner[order]


def _tiled(texts: pa.Array, block: Block, seed: int) -> Iterator[tuple[int, int, int, int]]:
    """(row, place of the item in the block, its words, those covered) for rows and items that share
    a seed."""

    def document(row: int, hashes: np.ndarray, places: np.ndarray, seeds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        hit_by: dict[int, list[int]] = defaultdict(list)
        first, last = np.searchsorted(block.seeds, seeds, "left"), np.searchsorted(block.seeds, seeds, "right")
        for place, a, b in zip(places.tolist(), first.tolist(), last.tolist()):
            for item in dict.fromkeys(block.owner[a:b].tolist()):
                hit_by[item].append(place)
        for item, at in sorted(hit_by.items()):
            # All tiles lie in the words under shared seeds; a gap between those is no word at all.
            text: list[int] = []
            end = -1
            for place in at:
                if place > end:
                    text.append(-1 - place)
                text += hashes[max(place, end) : place + seed].tolist()
                end = place + seed
            words = block.words[item]
            yield row, item, len(words), sum(k for _, _, k in tiles(words, text, seed))

    offsets, data = c.bytes_column(texts)
    for first, last in c.chunks(offsets):
        raw = data[offsets[first] : offsets[last]]
        starts, ends, ranges = c.words(raw, offsets[first : last + 1] - offsets[first])
        hashes = c.spans_hash(c.lowered(raw), starts, ends)
        grams = c.grams_hash(hashes, seed)
        if not len(grams) or not len(block.seeds):
            continue
        near = np.minimum(np.searchsorted(block.seeds, grams), len(block.seeds) - 1)
        hits = np.flatnonzero(block.seeds[near] == grams)
        owner = np.searchsorted(ranges, hits, "right") - 1
        inside = hits + seed <= ranges[owner + 1]
        hits, owner = hits[inside], owner[inside]
        edges = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])) if len(owner) else owner
        for places in np.split(hits, edges[1:]) if len(hits) else ():
            of = int(np.searchsorted(ranges, places[0], "right")) - 1
            yield from document(first + of, hashes[ranges[of] : ranges[of + 1]], places - ranges[of], grams[places])


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, seed: int) -> Iterator[Block]:
    """The benchmark in parts of about ``BLOCK_BYTES``."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES) or 1
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number).collect()
        yield Block(sorted(map(tuple, rows), key=str), seed)


OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_words", pa.int64()), ("n_covered", pa.int64())])


def _against(texts: DataFrame, block, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            ids = one.column("id").to_pylist()
            rows = [(ids[row], block.value.ids[item], n, k) for row, item, n, k in _tiled(one.column("text"), block.value, seed)]
            yield c.batch(dict(zip(OUT.names, map(list, zip(*rows)))) if rows else {k: [] for k in OUT.names}, OUT)

    return texts.mapInArrow(run, "doc_id long, item_id long, n_item_words long, n_covered long")


def contamination(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", seed: int = SEED, threshold: float = COVERAGE) -> DataFrame:
    """How much of each benchmark item each document holds.

    One row for each document and item that share a seed: doc_id, item_id, n_item_words, n_covered
    (long: the item's words under tiles of at least ``seed`` words), coverage (double), contaminated
    (coverage >= threshold). Words are split at ASCII white space, A-Z in lower case.

    Null and empty texts share nothing; an item of fewer than ``seed`` words has no seed and is never
    reported. Rows repeated on either side, or without an id, give rows of their own. Empty tables
    give an empty result; other columns are not read.
    """
    texts = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found = None
    for block in _blocks(benchmark, item_id, item_text, seed):
        part = _against(texts, documents.sparkSession.sparkContext.broadcast(block), seed)
        found = part if found is None else found.unionByName(part)
    coverage = F.col("n_covered") / F.col("n_item_words")
    return found.withColumn("coverage", coverage).withColumn("contaminated", coverage >= threshold)


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", seed: int = SEED, threshold: float = COVERAGE) -> DataFrame:
    """Documents, with all their columns, without those that hold a contaminating share of any item.

    Rows are judged one by one, so a row without an id is judged as any other; nothing is shuffled.
    """

    def without(rows: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for one in batches:
                bad = {row for row, _, n, k in _tiled(one.column(text), block.value, seed) if k >= threshold * n}
                yield one.filter(pa.array([row not in bad for row in range(one.num_rows)], pa.bool_()))

        return rows.mapInArrow(run, documents.schema)

    for block in _blocks(benchmark, item_id, item_text, seed):
        documents = without(documents, documents.sparkSession.sparkContext.broadcast(block))
    return documents
