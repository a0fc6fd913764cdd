"""The runs that move data between stored tables: ingest, silver, gold, gate.

Only here are actions taken. Each run recomputes its tables from the layer below, all of them or an
inclusive range of days. A run over a range also leaves out repeated deliveries whose first one lies
on a day before the range, so it keeps the same rows of these days as a full run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlumen.operators import gold
from adlumen.operators.gate import assert_gate, assert_null_rates, null_rates, quality_gate
from adlumen.operators.silver import duplicate_profiles, silver_outcomes, without_earlier
from adlumen.operators.validate import validate_impressions
from adlumen.sources.tables import (
    Tables, ingest_rows, read_bronze, read_gold, read_silver, write_gold, write_ingest,
    write_silver,
)


class DuplicateProfiles(ValueError):
    """The profile table holds several rows for one user."""


def run_ingest(messages: DataFrame, tables: Tables, batch_id: str | int, source: str) -> dict:
    """Validate and store one batch of messages (a frame with a ``value`` column).

    A batch is known by its source and its id: feeds that number their batches alike need sources of
    their own, or they would replace each other's rows.
    """
    return write_ingest(ingest_rows(validate_impressions(messages)), tables, batch_id, source).get


def refuse_duplicate_profiles(profiles: DataFrame) -> None:
    repeated = duplicate_profiles(profiles).first()
    if repeated is not None:
        raise DuplicateProfiles(f"user {repeated.user_id} has {repeated.profiles} profiles")


def run_silver(spark: SparkSession, tables: Tables, profiles: DataFrame,
               date_from: dt.date | None = None, date_to: dt.date | None = None) -> dict:
    """Recompute the silver tables from bronze; returns the run's counts.

    ``rows_before`` is counted in the same job, so a stream that appends meanwhile changes nothing.
    """
    refuse_duplicate_profiles(profiles)
    before = Observation()
    bronze = read_bronze(spark, tables, date_from, date_to).observe(before, F.count(F.lit(1)).alias("rows_before"))
    if date_from is not None:
        bronze = without_earlier(bronze, read_bronze(spark, tables, None, date_from - dt.timedelta(days=1)))
    counts = write_silver(silver_outcomes(bronze, profiles), tables, date_from, date_to).get
    return {**before.get, **counts}


def run_gold(spark: SparkSession, tables: Tables, date_from: dt.date | None = None,
             date_to: dt.date | None = None) -> dict:
    """Recompute the three gold tables from silver; returns their row counts."""
    legitimate = read_silver(spark, tables, "legitimate", date_from, date_to)
    fraud = read_silver(spark, tables, "fraud", date_from, date_to)
    results = {
        "revenue_by_advertiser": gold.revenue_by_advertiser(legitimate),
        "content_performance": gold.content_performance(legitimate),
        "fraud_summary": gold.fraud_summary(fraud),
    }
    return {
        name: write_gold(table, tables, name, date_from, date_to).get["rows"]
        for name, table in results.items()
    }


def run_gate(spark: SparkSession, tables: Tables, date_from: dt.date | None = None,
             date_to: dt.date | None = None) -> dict:
    """Check the stored tables, or a range of their days; raises ``GateFailed`` when a rule is broken."""
    bronze = read_bronze(spark, tables, date_from, date_to)
    result = assert_gate(quality_gate(
        bronze,
        read_silver(spark, tables, "legitimate", date_from, date_to),
        read_gold(spark, tables, "revenue_by_advertiser", date_from, date_to),
    ))
    assert_null_rates(null_rates(bronze))
    return result


def run_chain(spark: SparkSession, tables: Tables, profiles: DataFrame,
              messages: DataFrame | None = None, batch_id: str | int | None = None,
              source: str | None = None, date_from: dt.date | None = None,
              date_to: dt.date | None = None) -> dict:
    """Ingest (when messages are given), silver, gold, gate; the first failure ends the chain.

    With a range of days the steps after ingest read, replace and check these days only.
    """
    report = {}
    if messages is not None:
        if batch_id is None or source is None:
            raise ValueError("a batch of messages needs a batch_id and a source, so that it can be repeated")
        report["ingest"] = run_ingest(messages, tables, batch_id, source)
    report["silver"] = run_silver(spark, tables, profiles, date_from, date_to)
    report["gold"] = run_gold(spark, tables, date_from, date_to)
    report["gate"] = run_gate(spark, tables, date_from, date_to)
    return report
