"""Silver and gold brought up to date with the batches that have come since the last run.

Every write of a batch has a version, stored with its counts by day. A run compares these versions
with those that gold already holds: days of new versions have to be computed again, and so have the
days of versions that were replaced. A late batch may bring the first delivery of an id that later
days have already counted; the id index names those days. All other days of silver and gold are
neither read nor written.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.operators import gold
from adlumen.operators.silver import silver_outcomes
from adlumen.plans.runs import refuse_duplicate_profiles
from adlumen.schemas import APPLIED_SCHEMA
from adlumen.session import scratch_dir
from adlumen.sources.ids import first_deliveries, later_days, read_ids, write_ids
from adlumen.sources.tables import (
    Tables, is_stored, read_bronze, read_counts, read_silver, write_gold, write_silver,
)


def read_applied(spark: SparkSession, tables: Tables) -> DataFrame:
    """(version, ingestion_date) of what gold was computed from."""
    if not is_stored(spark, tables.applied):
        return spark.createDataFrame([], APPLIED_SCHEMA).select("version", "ingestion_date")
    log = spark.read.schema(APPLIED_SCHEMA).parquet(tables.applied)
    return log.groupBy("version", "ingestion_date").agg(F.sum("change").alias("n")).where("n > 0").drop("n")


def changes(spark: SparkSession, tables: Tables) -> DataFrame:
    """Versions and days that gold lacks (change 1), or holds though they were replaced (-1)."""
    there = read_counts(spark, tables).where("outcome = 'valid'").select("version", "ingestion_date")
    applied = read_applied(spark, tables)
    key = ["version", "ingestion_date"]
    new = there.join(applied, key, "left_anti").withColumn("change", F.lit(1))
    return new.unionByName(applied.join(there, key, "left_anti").withColumn("change", F.lit(-1)))


def run_incremental(spark: SparkSession, tables: Tables, profiles: DataFrame) -> dict:
    """Compute the days again that have changed; returns them with the counts of the run.

    What has changed is written down before anything is computed and recorded after everything is
    written. A run that fails is repeated over the same days; batches that come meanwhile are left
    to the next run, or taken in now and computed again then.
    """
    refuse_duplicate_profiles(profiles)
    noted = scratch_dir(spark, f"changes-{uuid.uuid4().hex[:8]}")
    changes(spark, tables).coalesce(1).write.parquet(noted)
    pending = spark.read.schema(APPLIED_SCHEMA).parquet(noted)
    days = {r[0] for r in pending.select("ingestion_date").distinct().collect()}
    if not days:
        return {"days": []}
    index = read_ids(spark, tables)
    # Ids that leave a day may make a later delivery the first, so ids of the index count as well.
    touched = read_bronze(spark, tables, days=days).select("impression_id", "ingestion_date")
    touched = touched.unionByName(index.where(F.col("ingestion_date").isin(list(days))))
    days |= set(later_days(touched, index.where(~F.col("ingestion_date").isin(list(days)))))

    bronze = read_bronze(spark, tables, days=days)
    other = index.where(~F.col("ingestion_date").isin(list(days)) & (F.col("ingestion_date") < F.lit(max(days))))
    counts = write_silver(silver_outcomes(first_deliveries(bronze, other), profiles), tables, days=days).get
    write_ids(bronze, tables, days)
    return {"days": sorted(days), **counts, "gold": run_gold_days(spark, tables, days), "applied": _record(pending, tables)}


def run_gold_days(spark: SparkSession, tables: Tables, days: set[dt.date]) -> dict:
    """The gold tables of these days, from silver of these days; returns their row counts."""
    legitimate = read_silver(spark, tables, "legitimate", days=days)
    results = {
        "revenue_by_advertiser": gold.revenue_by_advertiser(legitimate),
        "content_performance": gold.content_performance(legitimate),
        "fraud_summary": gold.fraud_summary(read_silver(spark, tables, "fraud", days=days)),
    }
    return {name: write_gold(table, tables, name, days=days).get["rows"] for name, table in results.items()}


def _record(pending: DataFrame, tables: Tables) -> int:
    """Append the run's changes; returns how many there were."""
    pending.coalesce(1).write.mode("append").parquet(tables.applied)
    return pending.count()
