"""Closed days of the ingest table rewritten into few files, ordered by advertiser.

Batches own their partitions, so a day's rows lie in as many folders as batches brought some, most
of them small. A layout is a copy of one day in files of about equal row counts, ranged by outcome,
advertiser and time. It is a copy of a state: of the versions of all batches that hold rows of the
day, as their stored counts name them. A reader takes the layout only while the day is still in that
state; after a late or repeated batch it reads the batches again, until the next run. So no order of
writes, compactions and failures loses or doubles a row.

A layout counts once its line is in the log, which is appended after its files are complete. A run
that fails leaves files nobody reads, and its days to the next run.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.schemas import COMPACTION_SCHEMA, INGEST_SCHEMA

if TYPE_CHECKING:
    from adlumen.sources.tables import Tables

# Some 100 MB of Parquet at the size of an impression.
ROWS_PER_FILE = 2_000_000

_ORDER = ["ingestion_date", "outcome", "advertiser_id", "timestamp"]
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def day_states(counts: DataFrame) -> DataFrame:
    """ingestion_date, rows and state of each stored day; any write of one of its batches changes the state."""
    return counts.groupBy("ingestion_date").agg(
        F.sum("rows").alias("rows"),
        F.bit_xor(F.xxhash64("version", "outcome")).alias("state"),
    )


def layouts(spark: SparkSession, tables: Tables) -> DataFrame:
    """ingestion_date, layout and state of every layout that was completed and not removed."""
    log = spark.read.schema(COMPACTION_SCHEMA).parquet(tables.compactions)
    return log.groupBy("ingestion_date", "layout", "state").agg(F.sum("change").alias("n")).where("n > 0").drop("n")


def current_layouts(counts: DataFrame, known: DataFrame | None) -> DataFrame:
    """Every stored day with its rows, its state and a layout of that state, NULL where there is none."""
    states = day_states(counts)
    if known is None:
        return states.withColumn("layout", F.lit(None).cast("string"))
    # Layouts of one state hold the same rows, so any of them will do.
    latest = known.groupBy("ingestion_date", "state").agg(F.max("layout").alias("layout"))
    return states.join(latest, ["ingestion_date", "state"], "left")


def read_batches(spark: SparkSession, tables: Tables, counts: DataFrame, days: Collection[dt.date | None]) -> DataFrame:
    """Rows of these days from their batches. Only the folders that hold some are listed."""
    named = [d for d in days if d is not None]
    of = F.col("ingestion_date").isin(named)
    of = of | F.col("ingestion_date").isNull() if None in days else of
    parts = counts.where(of).select("source", "batch_id", "outcome", "ingestion_date").distinct().collect()
    schema = INGEST_SCHEMA
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", tables.ingest).parquet(*[
        f"{tables.ingest}/source={p.source}/batch_id={p.batch_id}/outcome={p.outcome}/ingestion_date={p.ingestion_date or _NO_DATE}"
        for p in parts
    ]).select(*schema.fieldNames())


def read_layouts(spark: SparkSession, tables: Tables, chosen: dict[dt.date, str]) -> DataFrame:
    """Rows of days from the layouts chosen for them."""
    names = INGEST_SCHEMA.fieldNames()
    return spark.read.schema(INGEST_SCHEMA).option("basePath", tables.compacted).parquet(*[
        f"{tables.compacted}/layout={layout}/ingestion_date={day}" for day, layout in chosen.items()
    ]).select(*names)


def read_days(spark: SparkSession, tables: Tables, counts: DataFrame, days: DataFrame) -> DataFrame:
    """Stored rows of the days of a frame of ``current_layouts``, each day from its layout or else its batches."""
    asked = days.select("ingestion_date", "layout").collect()  # one row a day
    chosen = {r.ingestion_date: r.layout for r in asked if r.layout is not None}
    rest = [r.ingestion_date for r in asked if r.layout is None]
    if not chosen:
        return read_batches(spark, tables, counts, rest)
    rows = read_layouts(spark, tables, chosen)
    return rows.unionByName(read_batches(spark, tables, counts, rest)) if rest else rows


def write_layouts(spark: SparkSession, tables: Tables, counts: DataFrame, days: DataFrame, rows_per_file: int) -> list[dt.date]:
    """Write a layout for each of these days that has none; returns these days.

    An advertiser with a large share of a day is split by time and id over several files. The number
    of files follows the rows: a day of n rows takes n / ``rows_per_file`` files and at most three
    more, where a range goes on into the next day or outcome.
    """
    stale = days.where(F.col("ingestion_date").isNotNull() & F.col("layout").isNull()).collect()  # one row a day
    if not stale:
        return []
    layout = f"l{uuid.uuid4().hex}"
    names = [r.ingestion_date for r in stale]
    files = -(-sum(r.rows for r in stale) // rows_per_file)
    (
        read_batches(spark, tables, counts, names)
        .repartitionByRange(files, *_ORDER, F.xxhash64("impression_id", "value"))
        .sortWithinPartitions(*_ORDER)
        .write.partitionBy("ingestion_date", "outcome").parquet(f"{tables.compacted}/layout={layout}")
    )
    _log(spark, tables, [(r.ingestion_date, layout, r.state, 1) for r in stale])
    return sorted(names)


def remove_superseded(spark: SparkSession, tables: Tables, counts: DataFrame) -> int:
    """Remove layouts of states that their days have left; returns how many.

    For times when no earlier reader is still at work. They leave the log before the disk.
    """
    key = ["ingestion_date", "layout"]
    known = layouts(spark, tables)
    gone = known.join(current_layouts(counts, known).where("layout IS NOT NULL").select(*key), key, "left_anti").collect()
    if gone:
        _log(spark, tables, [(r.ingestion_date, r.layout, r.state, -1) for r in gone])
    for r in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.compacted}/layout={r.layout}/ingestion_date={r.ingestion_date}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(gone)


def _log(spark: SparkSession, tables: Tables, lines: list[tuple]) -> None:
    spark.createDataFrame(lines, COMPACTION_SCHEMA).coalesce(1).write.mode("append").parquet(tables.compactions)
