"""Quality gate over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.schemas import IMPRESSION_COLUMNS, MAX_FRAUD_RATE, MAX_NULL_RATE


class GateFailed(RuntimeError):
    """The tables do not satisfy the quality gate."""


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def quality_gate(bronze: DataFrame, legitimate: DataFrame, revenue: DataFrame) -> DataFrame:
    """One row: the gate's figures, the outcome of each rule, and ``passed`` for all of them.

    Each table is counted in its own scan (for a Parquet table from the file footers, plus the
    flag column of bronze); only one-row results meet.
    """
    def counted(table: DataFrame, name: str) -> DataFrame:
        return table.agg(F.count(F.lit(1)).alias("n")).withColumn("metric", F.lit(name))

    bronze_counts = bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.expr("is_fraud = true")).alias("fraud_rows"),
    ).unpivot([], ["bronze_rows", "fraud_rows"], "metric", "n")
    metrics = (
        counted(legitimate, "silver_rows")
        .unionByName(counted(revenue, "gold_rows"))
        .unionByName(bronze_counts)
    )
    figures = metrics.agg(*[
        F.max(F.when(F.col("metric") == name, F.col("n"))).alias(name)
        for name in ("silver_rows", "gold_rows", "bronze_rows", "fraud_rows")
    ])
    fraud_rate = F.when(
        F.col("bronze_rows") > 0, F.col("fraud_rows") / F.col("bronze_rows")
    ).otherwise(F.lit(0.0))
    return (
        figures.withColumn("silver_not_empty", F.col("silver_rows") > 0)
        .withColumn("gold_not_empty", F.col("gold_rows") > 0)
        .withColumn("fraud_rate_ok", fraud_rate < MAX_FRAUD_RATE)
        .withColumn("fraud_rate", F.round(fraud_rate, 4))
        .withColumn("passed", F.expr("silver_not_empty AND gold_not_empty AND fraud_rate_ok"))
    )


def assert_gate(gate: DataFrame) -> dict:
    """The gate's row as a dict; raises ``GateFailed`` naming the broken rules."""
    result = gate.first().asDict()
    broken = [rule for rule in ("silver_not_empty", "gold_not_empty", "fraud_rate_ok") if not result[rule]]
    if broken:
        raise GateFailed(f"{', '.join(broken)} failed: {result}")
    return result


def null_rates(impressions: DataFrame) -> DataFrame:
    """Share of NULLs per impression column and whether it is within the limit."""
    rates = impressions.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in IMPRESSION_COLUMNS],
    )
    return (
        rates.unpivot("rows", IMPRESSION_COLUMNS, "column_name", "null_count")
        .withColumn(
            "null_rate",
            F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows")).otherwise(F.lit(0.0)),
        )
        .select(
            "column_name", "null_count", F.round("null_rate", 4).alias("null_rate"),
            (F.col("null_rate") <= MAX_NULL_RATE).alias("within_limit"),
        )
    )


def assert_null_rates(rates: DataFrame) -> None:
    """Raises ``GateFailed`` naming the columns with too many NULLs; one row a column at most."""
    broken = [r.column_name for r in rates.where("NOT within_limit").collect()]
    if broken:
        raise GateFailed(f"more than {MAX_NULL_RATE:.0%} NULL in {', '.join(sorted(broken))}")


def assert_price_drift(drift: DataFrame) -> None:
    """Raise when prices of a day are too far from those of the day before; see ``bid_price_drift``."""
    moved = drift.where("NOT within_limit").orderBy("ingestion_date").collect()  # one row a day
    if moved:
        raise GateFailed("prices moved on " + ", ".join(f"{r.ingestion_date} ({r.distance})" for r in moved))
