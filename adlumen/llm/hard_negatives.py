"""Operator 11: hard negatives by segment summaries.

A vector is cut into segments of ``SEGMENTS`` components, coarse to fine. Of each segment its mean
and its deviation (the length of what differs from the mean) are stored. For vectors x and y and a
segment of n components,

    x . y  =  n * mean(x) * mean(y) + (x - mean) . (y - mean)

and the second product is at most deviation(x) * deviation(y) either way. Summed over the segments
these bound the score of a pair; pairs whose bounds leave the wanted range go, and the rest is
bounded again by finer segments and at last scored exactly.

Anchors are compared with all rows in cells: groups of anchors by groups of rows. A cell holds its
anchors and the best rows found for them, and takes its rows block by block. Nothing is collected,
no pair of rows leaves a cell but the first few of each anchor, and no label is a key, so a label of
very many rows weighs on no single task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from adlumen.llm import common as c

SCALE = 256
SEGMENTS = (64, 16, 4)
BLOCK_CELLS = 1 << 18
ANCHORS = 1 << 15
TILE = 256
# Squares of vectors: scores have to fit a long.
LARGEST = 2.0**62
LEAST = np.iinfo(np.int64).min
# Up to here a product of lengths leaves every partial sum of doubles exact.
EXACT = 2.0**52


@dataclass
class Vectors:
    """Rows with whole components, and their segments' means and deviations for each length."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    means: list[np.ndarray]
    deviations: list[np.ndarray]
    longest: float

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> Vectors:
        means, deviations = [], []
        for n in SEGMENTS:
            cut = values.reshape(len(values), -1, n)
            mean = cut.mean(axis=2)
            means.append(mean * np.sqrt(n))
            deviations.append(np.sqrt(((cut - mean[:, :, None]) ** 2).sum(axis=2)))
        return cls(ids, labels, values, means, deviations, float(np.sqrt((values**2).sum(axis=1).max(initial=0))))

    @classmethod
    def together(cls, parts: list[Vectors]) -> Vectors:
        """Parts of one width as one."""
        return cls(
            *(np.concatenate([getattr(p, k) for p in parts]) for k in ("ids", "labels", "values")),
            *([np.concatenate(x) for x in zip(*(getattr(p, k) for p in parts))] for k in ("means", "deviations")), max(p.longest for p in parts),
        )

    def some(self, at: np.ndarray | slice) -> Vectors:
        return Vectors(self.ids[at], self.labels[at], self.values[at], [x[at] for x in self.means], [x[at] for x in self.deviations], self.longest)

    def to_row(self) -> dict:
        """Summaries are stored with the vectors; all of them as packed arrays."""
        arrays = [self.values.astype(np.int64).reshape(-1), *(x.reshape(-1) for x in self.means), *(x.reshape(-1) for x in self.deviations)]
        return {"ids": c.compress(c.pack(self.ids)), "labels": c.compress(c.pack(self.labels)), "width": self.values.shape[1], "arrays": [c.compress(c.pack(x)) for x in arrays]}

    @classmethod
    def from_row(cls, row: dict) -> Vectors:
        raw = [c.decompress(x) for x in row["arrays"]]
        ids = c.unpack(c.decompress(row["ids"]), np.int64)
        floats = [c.unpack(x, np.float64).reshape(len(ids), -1) for x in raw[1:]]
        values = c.unpack(raw[0], np.int64).reshape(len(ids), row["width"]).astype(np.float64)
        n = len(SEGMENTS)
        return cls(ids, c.unpack(c.decompress(row["labels"]), np.int64), values, floats[:n], floats[n:], float(np.sqrt((values**2).sum(axis=1).max())))


PACKED = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("width", pa.int32()), ("arrays", pa.list_(pa.binary()))])
PACKED_SQL = "block long, ids binary, labels binary, width int, arrays array<binary>"


def usable_rows(embeddings: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, one for each id."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), values.alias("vector"), finite.alias("finite"))
    rows = rows.where("id is not null and label is not null and finite").drop("finite")
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def packed_blocks(rows: DataFrame, scale: int) -> DataFrame:
    """Rows in blocks of a bounded number of components, with their segments' summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            ids, labels = one.column("id").to_numpy(), one.column("label").to_numpy()
            lengths = one.column("vector").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.floor(scale * one.column("vector").flatten().to_numpy())
            starts = np.cumsum(lengths) - lengths
            widths = np.maximum(1, -(-lengths // SEGMENTS[0])) * SEGMENTS[0]
            order = np.argsort(widths, kind="stable")
            for width in np.unique(widths).tolist():
                of = order[np.searchsorted(widths[order], width) : np.searchsorted(widths[order], width, "right")]
                step = max(1, BLOCK_CELLS // width)
                for k in range(0, len(of), step):
                    at = of[k : k + step]
                    values = np.zeros((len(at), width))
                    row = np.repeat(np.arange(len(at)), lengths[at])
                    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths[at]) - lengths[at], lengths[at])
                    values[row, column] = flat[np.repeat(starts[at], lengths[at]) + column]
                    with np.errstate(over="ignore"):
                        small = (values**2).sum(axis=1) < LARGEST
                    if small.any():
                        some = Vectors.of(ids[at[small]], labels[at[small]], values[small])
                        yield c.batch({"block": [int(some.ids.min())], **{k: [v] for k, v in some.to_row().items()}}, PACKED)

    return rows.mapInArrow(run, PACKED_SQL)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (c.mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(groups)).astype(np.int32)


def anchor_pieces(blocks: DataFrame, every: int, groups: int) -> DataFrame:
    """The anchors of each block, by group of anchors."""
    kinds = pa.schema([("grp", pa.int32()), *PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            for row in one.to_pylist():
                if not (c.unpack(c.decompress(row["ids"]), np.int64) % every == 0).any():
                    continue
                rows = Vectors.from_row(row)
                rows = rows.some(rows.ids % every == 0)
                for number, at in c.by_part(group_of(rows.ids, groups)):
                    yield c.batch({"grp": [number], "block": [row["block"]], **{k: [v] for k, v in rows.some(at).to_row().items()}}, kinds)

    return blocks.mapInArrow(run, f"grp int, {PACKED_SQL}")


class FirstOf:
    """The first ``k`` of each slot by descending score, then by id, of all that are added."""

    def __init__(self, slots: int, k: int):
        self.k, self.held, self.new = k, (np.zeros(0, np.int64),) * 3, []
        self.size = 0
        self.least = np.full(slots, LEAST, np.int64)  # the score of a slot's k-th

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(slot):
            self.new.append((slot, score, ids))
            self.size += len(slot)
            if self.size > max(200_000, len(self.held[0])):
                self.settle()

    def settle(self) -> None:
        slot, score, ids = (np.concatenate([old, *(x[k] for x in self.new)]) for k, old in enumerate(self.held))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.append(True, np.diff(slot) != 0) if len(slot) else np.zeros(0, bool)
        rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(first, np.arange(len(slot)), 0)) if len(slot) else slot
        keep = rank < self.k
        full = rank == self.k - 1
        self.least[slot[full]] = score[full]
        self.held, self.new, self.size = (slot[keep], score[keep], ids[keep]), [], 0


def scored_pairs(anchors: Vectors, rows: Vectors, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, row) of those allowed whose score may lie from ``low`` to ``high`` of the
    anchor, with their scores. Bounds by segments, coarse to fine, then exact whole numbers."""
    slack = 1 + 1e-9 * anchors.longest * rows.longest
    a, r = np.nonzero(allowed & (low <= high)[:, None])
    many = allowed.size // 4
    for k, n in enumerate(SEGMENTS):
        if not len(a):
            break
        width = min(anchors.values.shape[1], rows.values.shape[1]) // n
        x = anchors.means[k][:, :width], anchors.deviations[k][:, :width]
        y = rows.means[k][:, :width], rows.deviations[k][:, :width]
        if len(a) > many:  # one product of matrices is cheaper than pairs one by one
            middle, reach = ((p @ q.T)[a, r] for p, q in zip(x, y))
        else:
            middle, reach = (np.einsum("ij,ij->i", p[a], q[r]) for p, q in zip(x, y))
        reach = reach + slack
        keep = (middle + reach >= low[a]) & (middle - reach <= high[a])
        a, r = a[keep], r[keep]
    if not len(a):
        return a, r, np.zeros(0, np.int64)
    width = min(anchors.values.shape[1], rows.values.shape[1])
    x, y = anchors.values[:, :width], rows.values[:, :width]
    if anchors.longest * rows.longest < EXACT:
        scores = (x @ y.T)[a, r] if len(a) > many else np.einsum("ij,ij->i", x[a], y[r])
        return a, r, scores.astype(np.int64)
    return a, r, (x[a].astype(np.int64) * y[r].astype(np.int64)).sum(axis=1)


FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])
FOUND_SQL = "anchor_id long, positive_id long, positive_score long, found_id long, score long"


class Positives:
    """A cell's search for the first rows of each anchor's own label."""

    def __init__(self, anchors: Vectors, wanted: dict, k: int):
        self.anchors, self.best = anchors, FirstOf(len(anchors.ids), k)

    def take(self, rows: Vectors) -> None:
        for first in range(0, len(self.anchors.ids), TILE):
            some = self.anchors.some(slice(first, first + TILE))
            allowed = (some.labels[:, None] == rows.labels) & (some.ids[:, None] != rows.ids)
            low = self.best.least[first : first + TILE]
            a, r, score = scored_pairs(some, rows, allowed, low.astype(float), np.full(len(low), np.inf))
            keep = score >= low[a]
            self.best.add(first + a[keep], score[keep], rows.ids[r[keep]])

    def found(self) -> dict:
        self.best.settle()
        slot, score, ids = self.best.held
        return {"anchor_id": self.anchors.ids[slot], "positive_id": ids, "positive_score": score, "found_id": ids, "score": score}


class Negatives:
    """A cell's search for the first rows of other labels within each positive's range of scores."""

    def __init__(self, anchors: Vectors, wanted: dict, k: int):
        of = [wanted.get(i, []) for i in anchors.ids.tolist()]
        some = np.array([at for at, x in enumerate(of) if x], np.int64)
        self.anchors = anchors.some(some)
        self.each = max([len(x) for x in of], default=0)
        shape = len(some), self.each
        self.ids, self.scores = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        # 30 * positive <= 100 * negative <= 90 * positive; no score does where there is no positive.
        self.low, self.high = np.ones(shape, np.int64), np.zeros(shape, np.int64)
        for row, at in enumerate(some.tolist()):
            for column, (ident, score) in enumerate(of[at]):
                self.ids[row, column], self.scores[row, column] = ident, score
                self.low[row, column], self.high[row, column] = -(-LOW * score // 100), HIGH * score // 100
        self.best = FirstOf(len(some) * self.each, k)

    def take(self, rows: Vectors) -> None:
        for first in range(0, len(self.anchors.ids), TILE):
            some = self.anchors.some(slice(first, first + TILE))
            high = self.high[first : first + TILE]
            least = self.best.least.reshape(-1, self.each)[first : first + TILE]
            low = np.maximum(self.low[first : first + TILE], least)
            wide = np.where(low <= high, low, np.inf).min(axis=1), np.where(low <= high, high, -np.inf).max(axis=1)
            a, r, score = scored_pairs(some, rows, some.labels[:, None] != rows.labels, *wide)
            for column in range(self.each):
                keep = (score >= low[a, column]) & (score <= high[a, column])
                self.best.add((first + a[keep]) * self.each + column, score[keep], rows.ids[r[keep]])

    def found(self) -> dict:
        self.best.settle()
        slot, score, ids = self.best.held
        row, column = slot // max(1, self.each), slot % max(1, self.each)
        return {"anchor_id": self.anchors.ids[row], "positive_id": self.ids[row, column], "positive_score": self.scores[row, column], "found_id": ids, "score": score}


LOW, HIGH = 30, 90  # percent of the positive's score


def searched(blocks: DataFrame, anchors: DataFrame, positives: DataFrame | None, groups: int, cells: int, k: int, search: type) -> DataFrame:
    """``search`` in every cell: each group of anchors by each group of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for one in batches for at in range(one.num_rows) for row in one.slice(at, 1).to_pylist())
        for _, cell in groupby(rows, key=lambda r: (r["grp"], r["part"])):
            pieces: dict[int, list[Vectors]] = defaultdict(list)
            wanted: dict[int, list] = {}
            searches: list | None = None
            for row in cell:
                if row["kind"] == 0:
                    pieces[row["width"]].append(Vectors.from_row(row))
                elif row["kind"] == 1:
                    wanted[row["block"]] = list(zip(row["positive_ids"], row["positive_scores"]))
                else:
                    if searches is None:
                        searches = [search(Vectors.together(x), wanted, k) for x in pieces.values()]
                        pieces.clear()
                    some = Vectors.from_row(row)
                    for one in searches:
                        one.take(some)
            for one in searches or []:
                yield c.batch(one.found(), FOUND)

    def spread(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    none = [F.lit(None).cast("array<long>").alias(k) for k in ("positive_ids", "positive_scores")]
    payload = ["block", "ids", "labels", "width", "arrays"]
    sides = anchors.select("grp", spread("part", cells), F.lit(0).alias("kind"), *payload, *none)
    if positives is not None:
        empty = [F.lit(None).cast(t).alias(n) for n, t in (("ids", "binary"), ("labels", "binary"), ("width", "int"), ("arrays", "array<binary>"))]
        sides = sides.unionByName(positives.select("grp", spread("part", cells), F.lit(1).alias("kind"), F.col("anchor_id").alias("block"), *empty, "positive_ids", "positive_scores"))
    sides = sides.unionByName(blocks.select(spread("grp", groups), F.pmod(F.xxhash64("block"), F.lit(cells)).cast("int").alias("part"), F.lit(2).alias("kind"), *payload, *none))
    return sides.repartition(groups * cells, "grp", "part").sortWithinPartitions("grp", "part", "kind").mapInArrow(run, FOUND_SQL)


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k of each key over all cells, of which each has sent at most k."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding", every: int = 100, positives: int = 5, negatives: int = 10, scale: int = SCALE) -> DataFrame:
    """Hard negatives of every anchor, a row whose id is divisible by ``every``.

    Components become floor(scale * x); a score is an inner product of these whole numbers. Of rows
    of the anchor's label the first by descending score, then ascending id, are its positives. For
    each of them the first rows of other labels with a score from 30 to 90 percent of the positive's
    are returned: anchor_id, positive_id, rank (int, from 1), negative_id, positive_score,
    negative_score (long).

    Rows with a null id, label or vector, or with a component that is null or not finite, take no
    part, nor do vectors whose squares sum up to 2 ** 62 or more: their scores may not fit a long.
    Of rows that share an id the least by label and vector counts. A shorter vector is as if filled
    up with zeros. A negative positive_score has no negatives. An empty table gives an empty result;
    other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = usable_rows(embeddings, vec_id, F.col(label) if isinstance(label, str) else label, vector)
    blocks = c.stored(packed_blocks(rows, scale), "vectors")
    # Anchors in groups that a task can hold, and cells enough to keep all cores busy.
    n_blocks = blocks.count()
    groups = max(1, -(-n_blocks * (BLOCK_CELLS // SEGMENTS[0]) // (every * ANCHORS)))
    cells = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // groups, n_blocks // 256)
    anchors = c.stored(anchor_pieces(blocks, every, groups), "anchors")
    own = ranked(searched(blocks, anchors, None, groups, cells, positives, Positives), ["anchor_id"], positives)
    own = own.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "found_id", "score"))).alias("found"))  # at most ``positives``

    def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            yield pa.RecordBatch.from_arrays([pa.array(group_of(one.column("anchor_id").to_numpy(), groups)), *one.columns], ["grp", *one.schema.names])

    wanted = own.select("anchor_id", F.col("found.found_id").alias("positive_ids"), F.col("found.score").alias("positive_scores"))
    wanted = c.stored(wanted.mapInArrow(by_group, "grp int, anchor_id long, positive_ids array<long>, positive_scores array<long>"), "positives")
    found = ranked(searched(blocks, anchors, wanted, groups, cells, negatives, Negatives), ["anchor_id", "positive_id"], negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
