"""Stored tables: where they are, how they are read and written.

``fmt`` is ``parquet`` by default. With ``delta``, when its package is on the class path, the same
tables are written with its atomic commits.

Writes end in a ``rebalance`` hint: adaptive execution then merges small output partitions and
splits large ones, such as a day or an outcome holding a large share of the rows, so file sizes
follow the data.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlumen.functions.columns import rate
from adlumen.operators.validate import with_ingestion_date
from adlumen.schemas import (
    BRONZE_COLUMNS, CONTENT_COLUMNS, COUNTS_SCHEMA, FRAUD_COLUMNS, IMPRESSION_COLUMNS, INGEST_SCHEMA,
    QUARANTINE_COLUMNS, REVENUE_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA,
)
from adlumen.sources.compaction import ROWS_PER_FILE, current_layouts, layouts, read_days, write_layouts

@dataclass(frozen=True)
class Tables:
    """Locations of the pipeline's tables below one root."""

    root: str
    fmt: str = "parquet"
    id_buckets: int = 16

    @property
    def ingest(self) -> str:
        return f"{self.root}/ingest/impressions"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/impressions"

    @property
    def counts(self) -> str:
        return f"{self.root}/ingest/counts"

    @property
    def compacted(self) -> str:
        return f"{self.root}/ingest/compacted"

    @property
    def compactions(self) -> str:
        return f"{self.root}/ingest/compactions"

    @property
    def applied(self) -> str:
        return f"{self.root}/gold/applied_batches"

    @property
    def ids(self) -> str:
        return f"{self.root}/silver/ids"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None) -> DataFrame:
    """A stored table with its declared schema; nothing is inferred from the files."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path)


def is_stored(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def between_dates(table: DataFrame, date_from: dt.date | None = None, date_to: dt.date | None = None,
                  days: Collection[dt.date] | None = None) -> DataFrame:
    """Rows of an inclusive range of ingestion dates, or of single days; on a stored table it prunes
    partitions."""
    if days is not None:
        table = table.where(F.col("ingestion_date").isin(list(days)))
    if date_from is not None:
        table = table.where(F.col("ingestion_date") >= F.lit(date_from))
    if date_to is not None:
        table = table.where(F.col("ingestion_date") <= F.lit(date_to))
    return table


def _range_files(spark: SparkSession, path: str, date_from: dt.date | None, date_to: dt.date | None,
                 days: Collection[dt.date] | None) -> dict[str, frozenset[str]]:
    """File names of each stored day of a range, by folder; a listing of folders, not of rows."""
    wanted = None if days is None else {str(d) for d in days}
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for depth in ("", "*/"):
        for day in files.globStatus(jvm.Path(root, f"{depth}ingestion_date=*")) or ():
            date = day.getPath().getName().partition("=")[2]
            if wanted is not None and date not in wanted:
                continue
            if (date_from is None or date >= str(date_from)) and (date_to is None or date <= str(date_to)):
                found[str(day.getPath())] = frozenset(f.getPath().getName() for f in files.listStatus(day.getPath()))
    return found


def _write_days(rows: DataFrame, path: str, fmt: str, by: list[str], date_from: dt.date | None,
                date_to: dt.date | None, days: Collection[dt.date] | None = None) -> None:
    """Replace the days of a range, single days, or all days, of a table partitioned by ``by``.

    Other days are not touched. Parquet replaces each partition that has new rows and
    then removes the old ones of the range that have none.
    """
    writer = rows.write.format(fmt).mode("overwrite").partitionBy(*by)
    if date_from is None and date_to is None and days is None:
        writer.save(path)
    elif fmt != "parquet" and days is not None:
        named = ", ".join(f"'{d}'" for d in sorted(days))
        writer.option("replaceWhere", f"ingestion_date IN ({named})").save(path)
    elif fmt != "parquet":
        low = [f"ingestion_date >= '{date_from}'"] if date_from else []
        high = [f"ingestion_date <= '{date_to}'"] if date_to else []
        writer.option("replaceWhere", " AND ".join(low + high)).save(path)
    else:
        spark = rows.sparkSession
        before = _range_files(spark, path, date_from, date_to, days)
        writer.option("partitionOverwriteMode", "dynamic").save(path)
        after = _range_files(spark, path, date_from, date_to, days)
        for folder, names in before.items():
            if after.get(folder) == names:
                stale = spark._jvm.org.apache.hadoop.fs.Path(folder)
                stale.getFileSystem(spark._jsc.hadoopConfiguration()).delete(stale, True)


# --- ingest: bronze and rejects -----------------------------------------------------------


def ingest_rows(validated: DataFrame) -> DataFrame:
    """Validated messages as stored: valid ones as bronze rows, rejected ones as raw text.

    A rejected message keeps its text and the broken rules. Its day is the day of ingestion,
    because its own timestamp cannot be trusted. Where the frame came from a topic, ``position``
    tells topic, partition and offset of either kind.
    """
    of = {"topic", "partition", "offset"}
    source = validated.schema["source"].dataType if "source" in validated.columns else None
    if isinstance(source, StructType) and of <= set(source.names):
        position = F.concat_ws("/", "source.topic", F.col("source.partition").cast("string"),
                               F.col("source.offset").cast("string"))
    else:
        position = F.lit(None).cast("string")
    is_valid = F.size("errors") == 0

    def if_valid(column: str | Column, name: str) -> Column:
        return F.when(is_valid, column if isinstance(column, Column) else F.col(column)).alias(name)

    return with_ingestion_date(validated).select(
        *[if_valid(c, c) for c in IMPRESSION_COLUMNS],
        F.when(~is_valid, F.col("value").cast("string")).alias("value"),
        F.when(~is_valid, F.col("errors")).alias("errors"),
        position.alias("position"),
        F.when(is_valid, F.lit("valid")).otherwise(F.lit("rejected")).alias("outcome"),
        F.when(is_valid, F.col("ingestion_date")).otherwise(F.current_date()).alias("ingestion_date"),
    )


def write_ingest(rows: DataFrame, tables: Tables, batch_id: str | int, source: str) -> Observation:
    """Add one batch to the ingest table, in one pass over it.

    A batch of a source owns its own partition, so writing it again under the same id replaces all
    of it instead of duplicating it, and batches of other sources are never touched. A stream's
    source is the id of its query. The returned observation holds the batch's counts; it sits in the
    writing stage, where a repeated task is not counted twice.

    After the rows their counts by outcome and day are stored, under a version of their own for each
    write: totals are read from them alone, and the version tells later runs what has changed. A
    write that ends in between is repeated as a whole.
    """
    batch = str(batch_id)
    for name in (batch, source):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError(f"batch id or source {name!r} may only have letters, digits and _.-")
    counts = Observation()
    observed = rows.hint("rebalance", F.col("outcome"), F.col("ingestion_date")).observe(
        counts,
        F.count_if(F.col("outcome") == "valid").alias("valid_count"),
        F.count_if(F.col("outcome") == "rejected").alias("invalid_count"),
        F.count_if("is_fraud").alias("fraud_count"),
    )
    if tables.fmt == "parquet":
        writer = observed.write.partitionBy("outcome", "ingestion_date")
        target = f"{tables.ingest}/source={source}/batch_id={batch}"
    else:
        writer = (
            observed.withColumns({"source": F.lit(source), "batch_id": F.lit(batch)})
            .write.partitionBy("source", "batch_id", "outcome", "ingestion_date")
            .option("replaceWhere", f"source = '{source}' AND batch_id = '{batch}'")
        )
        target = tables.ingest
    writer.format(tables.fmt).mode("overwrite").save(target)
    _write_counts(rows.sparkSession, tables, source, batch)
    return counts


def _write_counts(spark: SparkSession, tables: Tables, source: str, batch: str) -> None:
    """Counts of one stored batch; of its rows only the fraud flag is read."""
    if tables.fmt == "parquet":
        schema = StructType([f for f in INGEST_SCHEMA if f.name not in ("source", "batch_id")])
        stored = spark.read.schema(schema).parquet(f"{tables.ingest}/source={source}/batch_id={batch}")
    else:
        stored = read_ingest(spark, tables).where((F.col("source") == source) & (F.col("batch_id") == batch))
    by_day = stored.groupBy("outcome", "ingestion_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_fraud").alias("fraud_rows"))
    (
        by_day.withColumn("version", F.lit(uuid.uuid4().hex)).coalesce(1)
        .write.mode("overwrite").parquet(f"{tables.counts}/source={source}/batch_id={batch}")
    )


def read_counts(spark: SparkSession, tables: Tables) -> DataFrame:
    """Rows of every stored batch by outcome and day."""
    return spark.read.schema(COUNTS_SCHEMA).parquet(tables.counts)


def read_ingest(spark: SparkSession, tables: Tables, date_from: dt.date | None = None,
                date_to: dt.date | None = None, days: Collection[dt.date] | None = None) -> DataFrame:
    """All stored messages, or those of some days; days that were compacted come from their layouts."""
    if tables.fmt == "parquet" and is_stored(spark, tables.compactions):
        counts = read_counts(spark, tables)
        stored = current_layouts(counts, layouts(spark, tables))
        return read_days(spark, tables, counts, between_dates(stored, date_from, date_to, days))
    return between_dates(read_table(spark, tables.ingest, tables.fmt, INGEST_SCHEMA), date_from, date_to, days)


def compact_ingest(spark: SparkSession, tables: Tables, until: dt.date | None = None,
                   days: Collection[dt.date] | None = None, rows_per_file: int = ROWS_PER_FILE) -> list[dt.date]:
    """Rewrite days into few files ordered by advertiser; returns those that needed it.

    ``until`` is the first day that is still open, ``days`` names some instead. Running it again
    takes only days that batches have changed since. Delta tables have commands of their own.
    """
    if tables.fmt != "parquet":
        raise ValueError("only Parquet tables are compacted here")
    if until is None and days is None:
        raise ValueError("name the first open day or the days to compact")
    counts = read_counts(spark, tables)
    known = layouts(spark, tables) if is_stored(spark, tables.compactions) else None
    closed = None if until is None else until - dt.timedelta(days=1)
    asked = between_dates(current_layouts(counts, known), None, closed, days)
    return write_layouts(spark, tables, counts, asked, rows_per_file)


def read_bronze(spark: SparkSession, tables: Tables, date_from: dt.date | None = None,
                date_to: dt.date | None = None, days: Collection[dt.date] | None = None) -> DataFrame:
    stored = read_ingest(spark, tables, date_from, date_to, days)
    return stored.where("outcome = 'valid'").select(*BRONZE_COLUMNS)


def read_rejects(spark: SparkSession, tables: Tables) -> DataFrame:
    return read_ingest(spark, tables).where("outcome = 'rejected'").select(
        "value", "errors", "ingestion_date", "batch_id"
    )


def stored_ingest_stats(spark: SparkSession, tables: Tables) -> DataFrame:
    """Totals over all stored batches, from their counts alone: the rows are not read again, and
    unlike counters in a process the totals survive a restart."""
    counts = read_counts(spark, tables)
    of = F.col("outcome")
    return counts.agg(
        F.coalesce(F.sum(F.when(of == "valid", F.col("rows"))), F.lit(0)).alias("valid_count"),
        F.coalesce(F.sum(F.when(of == "rejected", F.col("rows"))), F.lit(0)).alias("invalid_count"),
        F.coalesce(F.sum(F.when(of == "valid", F.col("fraud_rows"))), F.lit(0)).alias("fraud_count"),
    ).withColumn("fraud_rate", rate(F.col("fraud_count"), F.col("valid_count")))


# --- silver -------------------------------------------------------------------------------


def write_silver(outcomes: DataFrame, tables: Tables, date_from: dt.date | None = None,
                 date_to: dt.date | None = None, days: Collection[dt.date] | None = None) -> Observation:
    """Replace all silver tables, or some of their days, in one job.

    Legitimate, fraud and quarantine rows are partitions of one location, so the shared work
    (deduplication, flags, join) runs once without caching it, and a run without quarantined rows
    also clears the earlier ones.
    """
    counts = Observation()
    of = F.col("outcome")
    rows = (
        outcomes.hint("rebalance", of, F.col("ingestion_date"))
        .observe(
            counts,
            F.count_if(of == "legitimate").alias("legitimate"),
            F.count_if(of == "fraud").alias("fraud"),
            F.count_if(of == "quarantine").alias("quarantined"),
            F.count_if((of != "quarantine") & F.col("account_tier").isNull()).alias("missing_profiles"),
        )
    )
    _write_days(rows, tables.silver, tables.fmt, ["outcome", "ingestion_date"], date_from, date_to, days)
    return counts


def read_silver(spark: SparkSession, tables: Tables, outcome: str,
                date_from: dt.date | None = None, date_to: dt.date | None = None,
                days: Collection[dt.date] | None = None) -> DataFrame:
    """The ``legitimate``, ``fraud`` or ``quarantine`` table."""
    columns = QUARANTINE_COLUMNS if outcome == "quarantine" else SILVER_COLUMNS
    table = read_table(spark, tables.silver, tables.fmt, SILVER_SCHEMA)
    return between_dates(table.where(F.col("outcome") == outcome).select(*columns), date_from, date_to, days)


# --- gold ---------------------------------------------------------------------------------


GOLD_COLUMNS = {
    "revenue_by_advertiser": REVENUE_COLUMNS,
    "content_performance": CONTENT_COLUMNS,
    "fraud_summary": FRAUD_COLUMNS,
}


def write_gold(table: DataFrame, tables: Tables, name: str, date_from: dt.date | None = None,
               date_to: dt.date | None = None, days: Collection[dt.date] | None = None) -> Observation:
    """Replace one gold table, or some of its days; the number of files follows its size."""
    counts = Observation()
    rows = table.hint("rebalance", F.col("ingestion_date")).observe(counts, F.count(F.lit(1)).alias("rows"))
    _write_days(rows, tables.gold(name), tables.fmt, ["ingestion_date"], date_from, date_to, days)
    return counts


def read_gold(spark: SparkSession, tables: Tables, name: str, date_from: dt.date | None = None,
              date_to: dt.date | None = None) -> DataFrame:
    table = read_table(spark, tables.gold(name), tables.fmt).select(*GOLD_COLUMNS[name])
    return between_dates(table, date_from, date_to)
