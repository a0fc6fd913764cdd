"""The index of stored impression ids: which ids each day of bronze holds.

It is bucketed by id and partitioned by day, so a join on the id takes it as it lies: only the rows
it is asked for are shuffled, to its buckets, and the ids of all history stay where they are. A
table's bucket count is part of its files; ``Tables.id_buckets`` must not change for a stored index.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.sources.tables import Tables, is_stored

# Stands for an id of NULL, which deduplication takes for one id. A NULL-safe join would not use the
# buckets.
_NO_ID = "\0"


def _key() -> Column:
    return F.coalesce(F.col("impression_id"), F.lit(_NO_ID))


def _name(tables: Tables) -> str:
    return f"adlumen_ids_{hashlib.sha256(tables.ids.encode()).hexdigest()[:16]}"


def _declared(spark: SparkSession, tables: Tables) -> str:
    """The index's name in the session's catalog, which may not outlive the session as the files do."""
    name = _name(tables)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} (impression_id STRING, ingestion_date DATE) USING parquet "
            f"PARTITIONED BY (ingestion_date) CLUSTERED BY (impression_id) INTO {tables.id_buckets} BUCKETS "
            f"LOCATION '{tables.ids}'"
        )
    if is_stored(spark, tables.ids):
        spark.sql(f"MSCK REPAIR TABLE {name}")  # days that another session has stored
    return name


def read_ids(spark: SparkSession, tables: Tables) -> DataFrame:
    """impression_id and ingestion_date, each id once for a day."""
    return spark.table(_declared(spark, tables))


def write_ids(rows: DataFrame, tables: Tables, days: Collection[dt.date]) -> None:
    """Replace the index's days by the ids of these rows; one file for each bucket and day."""
    spark = rows.sparkSession
    name = _declared(spark, tables)
    ids = rows.select(_key().alias("impression_id"), "ingestion_date").distinct().repartition(tables.id_buckets, "impression_id")
    gone = {str(d) for d in days} - {str(r[0]) for r in rows.select("ingestion_date").distinct().collect()}
    mode = "spark.sql.sources.partitionOverwriteMode"  # inserts into a table know no such option
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ids.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    for day in sorted(gone):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (ingestion_date = DATE '{day}')")
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.ids}/ingestion_date={day}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def first_deliveries(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose id the index holds on no earlier day.

    To be given the index without the days of ``rows`` themselves.
    """
    known = index.select(F.col("impression_id").alias("_id"), F.col("ingestion_date").alias("_day"))
    return rows.join(known, (_key() == F.col("_id")) & (F.col("_day") < F.col("ingestion_date")), "left_anti")


def later_days(rows: DataFrame, index: DataFrame) -> list[dt.date]:
    """Days on which the index holds an id of ``rows`` after the row's own day."""
    known = index.select(F.col("impression_id").alias("_id"), F.col("ingestion_date").alias("_day"))
    asked = rows.select(_key().alias("impression_id"), "ingestion_date")
    found = asked.join(known, (F.col("impression_id") == F.col("_id")) & (F.col("_day") > F.col("ingestion_date"))).select("_day").distinct()
    return sorted(r[0] for r in found.collect())  # as many as there are days at most
