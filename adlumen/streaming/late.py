"""Deduplication of a stream that loses no late row.

A watermark bounds what a stream has to remember, and Spark's stateful operators drop what comes
later. Here a batch is parted by the watermark first: rows in time are told apart by the ids of the
days that the delay reaches back to, and late ones, few as they are, by the ids of all that was
stored. Both decisions are made against stored tables, so they hold over restarts, and a batch that
is repeated makes them again without its own first result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, DateType, LongType, StructField, StructType, TimestampType

from adlumen.operators.silver import dedup_impressions
from adlumen.schemas import BRONZE_SCHEMA
from adlumen.sources.tables import is_stored

_CLOCK = StructType([StructField("latest", TimestampType()), StructField("batch", LongType())])
STORED = StructType([f for f in BRONZE_SCHEMA if f.name != "ingestion_date"])


def _kept(spark: SparkSession, root: str, batch: int, since: dt.datetime | None = None) -> DataFrame:
    """Ids of earlier batches, in time or late; of days from ``since`` on if given."""
    if not is_stored(spark, f"{root}/rows"):
        return spark.createDataFrame([], "impression_id STRING")
    stored = spark.read.schema("impression_id STRING, batch LONG, late BOOLEAN, ingestion_date DATE").parquet(f"{root}/rows")
    stored = stored.where(F.col("batch") < batch)
    if since is not None:  # a late row never stands for one in time, so late partitions stay in
        stored = stored.where((F.col("ingestion_date") >= F.lit(since.date())) | F.col("late"))
    return stored.select("impression_id")


def _clock(spark: SparkSession, root: str, batch: int) -> dt.datetime | None:
    """The latest time of the batches before."""
    if not is_stored(spark, f"{root}/clock"):
        return None
    return spark.read.schema(_CLOCK).parquet(f"{root}/clock").where(F.col("batch") < batch).agg(F.max("latest")).first()[0]


def store_batch(rows: DataFrame, batch: int, root: str, delay: dt.timedelta) -> None:
    """Store the rows of a batch that no earlier batch has stored, late ones under ``late=true``.

    A row is late if its time is more than ``delay`` before the latest time of the batches before.
    Of repeated deliveries within a batch the earliest stays. A row in time is compared with the
    stored rows of its own and the delay's days, since an earlier delivery that is further back than
    that is as good as lost to a stream; a late one with all of them.
    """
    spark = rows.sparkSession
    once = dedup_impressions(rows.select(*STORED.fieldNames()))
    clock = _clock(spark, root, batch)
    limit = None if clock is None else clock - delay
    is_late = F.lit(False) if limit is None else F.coalesce(F.col("timestamp") < F.lit(limit), F.lit(False))
    marked = once.withColumn("late", is_late)

    def unseen(part: DataFrame, ids: DataFrame) -> DataFrame:
        known = ids.select(F.col("impression_id").alias("_id"))
        return part.join(known, F.col("impression_id").eqNullSafe(F.col("_id")), "left_anti")

    out = unseen(marked.where("NOT late"), _kept(spark, root, batch, limit))
    if limit is not None:
        out = out.unionByName(unseen(marked.where("late"), _kept(spark, root, batch)))
    (
        out.withColumns({"batch": F.lit(batch).cast("long"), "ingestion_date": F.to_date("timestamp")})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch", "late", "ingestion_date").parquet(f"{root}/rows")
    )
    latest = rows.agg(F.max("timestamp").alias("latest"))
    latest.withColumn("batch", F.lit(batch).cast("long")).coalesce(1).write.mode("overwrite").partitionBy("batch").option(
        "partitionOverwriteMode", "dynamic").parquet(f"{root}/clock")


def start_dedup_with_late(impressions: DataFrame, root: str, checkpoint: str,
                          delay: dt.timedelta = dt.timedelta(hours=1)) -> StreamingQuery:
    """Deduplicate what is there, in bounded batches, and end."""
    return (
        impressions.writeStream.foreachBatch(lambda rows, batch: store_batch(rows, batch, root, delay))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_deduplicated(spark: SparkSession, root: str, late: bool | None = None) -> DataFrame:
    """The kept rows, all of them or only the late ones or those in time."""
    schema = StructType([*STORED, StructField("late", BooleanType()), StructField("ingestion_date", DateType())])
    rows = spark.read.schema(schema).parquet(f"{root}/rows")
    if late is not None:
        rows = rows.where(F.col("late") == late)
    return rows.select(*STORED.fieldNames(), "ingestion_date")
