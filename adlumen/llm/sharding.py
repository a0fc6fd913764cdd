"""Operator 12: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of a block go to each shard in a uniform shuffle follows a multivariate hypergeometric
law: the matrix of all these counts has the blocks' sizes as its row sums and the shards' as its
column sums. Drawn first, it lets every block deal its rows out alone:

1. Rows are stored in blocks of at most 2 ** ``BLOCK_BITS``, numbered within their block.
2. The matrix is drawn in two levels, so that no task draws much of it: first for at most ``GROUPS``
   groups of blocks, on the driver from their sizes, then in each group for its blocks.
3. A block permutes its rows and deals them out by its row of the matrix.
4. Rows are exchanged, once, and put into random order within their shard: each has a random number
   whose leading part is its bin in the shard. Bins are sorted, and their first slots are sums of
   the counts of the bins before.

All draws are seeded by the block's number and the row's place in it, and blocks are read from a
stored table, so a repeated task deals the same rows to the same places.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from adlumen.llm import common as c

BLOCK_BITS = 18  # of the number of a row in its block
GROUPS = 256
# Rows of a bin of a shard, on the average.
BIN_ROWS = 50_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` out of good and bad ones are good; for numbers of any size.

    By inversion over the values within 14 deviations of the mode, whose weights follow from the
    ratios of neighbouring ones. What lies outside has a probability under 1e-40.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low >= high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1)))
    reach = int(14 * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    weights = np.append(0.0, np.cumsum(steps))
    weights = np.cumsum(np.exp(weights - weights.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], "right"))


def split_counts(rng: np.random.Generator, left: list[int], drawn: int) -> list[int]:
    """A multivariate hypergeometric draw: how many of ``drawn`` fall to each shard, if ``left``
    places are free in them."""
    out, rest = [], sum(left)
    for places in left:
        rest -= places
        out.append(hypergeometric(rng, places, rest, drawn))
        drawn -= out[-1]
    return out


def communication_rows(seed: tuple[int, ...], sizes: list[int], places: list[int]) -> list[list[int]]:
    """The matrix for sources of these sizes and shards with these places, a row for each source."""
    rng = np.random.default_rng(seed)
    left, out = list(places), []
    for size in sizes:
        out.append(split_counts(rng, left, size))
        left = [a - b for a, b in zip(left, out[-1])]
    return out


def in_blocks(documents: DataFrame) -> DataFrame:
    """The rows in a struct ``row``, with the number of their block and their place in it; stored."""
    names = [k.replace("`", "``") for k in documents.columns]
    number = F.monotonically_increasing_id()  # counts the rows of a task in its lower 33 bits
    rows = documents.select(F.struct(*(F.col(f"`{k}`") for k in names)).alias("row"), number.alias("number"))
    return c.stored(rows.select("row", F.shiftright("number", BLOCK_BITS).alias("block"), F.col("number").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("place")), "shard_blocks")


def matrix(made: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (block, counts) of the communication matrix; shards differ by one row at most."""
    sizes = made.groupBy("block").agg(F.count("*").alias("size")).withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(GROUPS)).cast("int"))
    sizes = c.stored(sizes, "shard_sizes")
    groups = sorted((r[0], r[1]) for r in sizes.groupBy("grp").agg(F.sum("size")).collect())  # at most GROUPS rows
    total = sum(n for _, n in groups)
    places = [total // shards + (k < total % shards) for k in range(shards)]
    drawn = communication_rows((seed, 0), [n for _, n in groups], places)
    spark = made.sparkSession
    by_group = spark.createDataFrame([(g, row) for (g, _), row in zip(groups, drawn)], "grp int, places array<long>")

    def draw(key: tuple, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("block")
        rows = communication_rows((seed, 1, key[0].as_py()), blocks.column("size").to_pylist(), blocks.column("places")[0].as_py())
        return pa.table({"block": blocks.column("block"), "counts": pa.array(rows, pa.list_(pa.int64()))})

    return c.stored(sizes.join(F.broadcast(by_group), "grp").groupBy("grp").applyInArrow(draw, "block long, counts array<long>"), "shard_matrix")


def dealt(rows: DataFrame, seed: int, bins: list[int]) -> DataFrame:
    """Adds shard, bin and the random number ``draw`` to rows with block, place and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, ()
        for one in batches:
            block, place = one.column("block").to_numpy(), one.column("place").to_numpy()
            shard, draw = np.empty(len(block), np.int32), np.empty(len(block), np.int64)
            for number in np.unique(block).tolist():
                at = np.flatnonzero(block == number)
                if number != of:
                    rng = np.random.default_rng((seed, 2, number))
                    counts = np.array(one.column("counts")[int(at[0])].as_py(), np.int64)
                    size = int(counts.sum())
                    held = rng.permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts)), rng.integers(0, 1 << 62, size)
                    of = number
                shard[at], draw[at] = held[0][place[at]], held[1][place[at]]
            bin_ = ((draw >> 31) * np.array(bins, np.int64)[shard] >> 31).astype(np.int32)
            kept = [k for k in one.schema.names if k != "counts"]
            yield pa.RecordBatch.from_arrays([*(one.column(k) for k in kept), pa.array(shard), pa.array(bin_), pa.array(draw)], [*kept, "shard", "bin", "draw"])

    kinds = StructType([*(f for f in rows.schema if f.name != "counts"), StructField("shard", IntegerType()), StructField("bin", IntegerType()), StructField("draw", LongType())])
    return rows.mapInArrow(run, kinds)


def shuffle_into_shards(documents: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """Every row of ``documents`` with a shard and a slot in it, by a uniform random permutation.

    Shard sizes are exact: they differ by one row at most, whatever the rows are, so a very common
    text does not weigh on one shard. Equal texts are not kept together. Returns ``row`` (a struct
    of all input columns, whatever their names), shard (int, from 0), slot (long, gapless from 0 in
    each shard).

    Nulls, empty texts and repeated rows are rows like others, each with a place of its own. With
    fewer rows than shards the last shards are empty; an empty table gives an empty result. The same
    table, blocks and seed give the same permutation.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    made = in_blocks(documents)
    counts = matrix(made, shards, seed)
    total = made.count()
    bins = [max(1, -(-(total // shards + (k < total % shards)) // BIN_ROWS)) for k in range(shards)]
    # Places first, without the rows' content: bins and how many rows each has.
    narrow = dealt(made.select("block", "place").join(counts, "block"), seed, bins)
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = narrow.groupBy("shard", "bin").agg(F.count("*").alias("n")).select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("shard", "bin").orderBy("draw", "block", "place")
    rows = dealt(made.join(counts, "block"), seed, bins).withColumn("rank", F.row_number().over(order) - 1)
    return rows.join(bases, ["shard", "bin"]).select("row", "shard", (F.col("base") + F.col("rank")).cast("long").alias("slot"))


def sharded_digest(sharded: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size (long: UTF-8 bytes and 16), text_crc32, law (``rows``), shard, slot, grown_shard
    (null under this law) of ``shuffle_into_shards``. A null text has no bytes."""

    def of(name: str) -> Column:
        return F.col("row").getField(name)

    content = F.coalesce(of(text), F.lit(""))
    return sharded.select(
        of(doc_id).cast("long").alias("doc_id"), (F.octet_length(content) + 16).cast("long").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
