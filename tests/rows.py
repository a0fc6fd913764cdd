"""Hand-written rows for the tests."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from adlumen.schemas import BRONZE_SCHEMA, PROFILE_SCHEMA, SILVER_COLUMNS
from adlumen.operators.validate import with_ingestion_date

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)

IMPRESSION = {
    "impression_id": "imp_1", "user_id": "user_000001", "advertiser_id": "adv_001",
    "campaign_id": "camp_001", "content_id": "cnt_001", "bid_price": 0.45, "currency": "USD",
    "country_code": "US", "device_type": "mobile", "ad_format": "video", "timestamp": T0,
    "is_fraud": False,
}
MESSAGE = {**IMPRESSION, "timestamp": "2024-03-01T12:00:00Z"}


def bronze(spark: SparkSession, *changes: dict) -> DataFrame:
    """Bronze rows that differ from a valid impression as told; ids are numbered by default."""
    rows = [
        {**IMPRESSION, "impression_id": f"imp_{i}", **change, "ingestion_date": None}
        for i, change in enumerate(changes)
    ]
    frame = spark.createDataFrame(
        [tuple(r[c] for c in BRONZE_SCHEMA.fieldNames()) for r in rows], BRONZE_SCHEMA
    )
    return with_ingestion_date(frame)


def silver(spark: SparkSession, *changes: dict) -> DataFrame:
    """Enriched rows; profile columns are NULL unless given."""
    from adlumen.operators.silver import enrich

    profile = {"account_tier": None, "is_verified": None}
    tiers = [
        (f"u{i}", c.get("account_tier"), "US", "USD", c.get("is_verified"), T0)
        for i, c in enumerate(changes) if "account_tier" in c
    ]
    rows = [
        {"user_id": f"u{i}", **{k: v for k, v in c.items() if k not in profile}}
        for i, c in enumerate(changes)
    ]
    return enrich(bronze(spark, *rows), spark.createDataFrame(tiers, PROFILE_SCHEMA)).select(*SILVER_COLUMNS)


def profiles(spark: SparkSession, *users: tuple) -> DataFrame:
    return spark.createDataFrame(
        [(u, tier, "US", "USD", verified, T0) for u, tier, verified in users], PROFILE_SCHEMA
    )


def messages(spark: SparkSession, *values) -> DataFrame:
    """JSON messages: dicts as changes to a valid one (``...`` drops a field), text as it is."""
    def text(value):
        if isinstance(value, dict):
            return json.dumps({k: v for k, v in {**MESSAGE, **value}.items() if v is not ...})
        return value

    return spark.createDataFrame([(i, text(v)) for i, v in enumerate(values)], "n INT, value STRING")


def collect(frame: DataFrame, *columns: str) -> list[tuple]:
    """Sorted rows as tuples."""
    rows = frame.select(*columns).collect() if columns else frame.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])
