"""The pipeline's input tables, derived by Spark from the generic star-schema tables.

Each function is a narrow projection of one table (duplicates come from an ``explode`` of a one-
or two-element array, not from a second scan), so it keeps the table's partitioning and its work
grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.functions.columns import code, pick
from adlumen.schemas import (
    AD_FORMATS, BRONZE_COLUMNS, COUNTRIES, COUNTRY_CURRENCY, INGEST_CURRENCIES,
    SILVER_CURRENCIES,
)

def _id() -> Column:
    return F.col("event_id")



def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _mapped(column: str, mapping: dict[str, str]) -> Column:
    out = F
    for key, value in mapping.items():
        out = out.when(F.col(column) == key, F.lit(value))
    return out


def _advertiser() -> Column:
    return code("adv_", _id() * 31 % 997 % 20 + 1, 3)


def _campaign() -> Column:
    return code("camp_", _id() * 17 % 991 % 50 + 1, 3)


def _content() -> Column:
    return code("cnt_", _id() * 13 % 983 % 100 + 1, 3)


def _event_time() -> Column:
    return F.col("ts").cast("timestamp")


def impressions_with_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze impressions plus ``event_id`` and ``copy`` (1 on the repeated deliveries)."""
    fraud = F.get_json_object("props", "$.k").cast("int") >= 97
    deliveries = F.when(_id() % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    columns = {
        "impression_id": code("imp_", _id(), 10),
        "user_id": F.when(fraud, code("bot_", _id() % 10 + 1, 3))
                    .when(_id() % 211 == 0, F.lit(None))
                    .otherwise(code("user_", F.col("user_id"), 6)),
        "advertiser_id": _advertiser(),
        "campaign_id": _campaign(),
        "content_id": _content(),
        "bid_price": F.when(_id() % 307 != 0, F.col("value") / 5),
        "currency": F.when(_id() % 40 == 39, F.lit("JPY")).otherwise(pick(_id() % 9, SILVER_CURRENCIES)),
        "country_code": F.when(_id() % 37 == 0, F.lit("XX"))
                         .when(_id() % 401 != 0, pick(_id() * 7 % 101 % 10, COUNTRIES)),
        "device_type": _mapped("event_type", {
            "view": "mobile", "click": "desktop", "signup": "tablet",
            "purchase": "ctv", "error": "desktop"}),
        "ad_format": pick(_id() * 11 % 103 % 4, AD_FORMATS),
        "timestamp": F.timestamp_add("SECOND", F.col("copy"), _event_time()),
        "is_fraud": fraud,
    }
    return (
        load(spark, sf_dir, "events")
        .withColumn("copy", F.explode(deliveries))
        .select("event_id", "copy", *[c.alias(name) for name, c in columns.items()])
        .withColumn("ingestion_date", F.to_date("timestamp"))
    )


def impressions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impressions_with_source(spark, sf_dir).select(*BRONZE_COLUMNS)


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = pick(F.col("c_nationkey") % 10, COUNTRIES)
    return load(spark, sf_dir, "customer").where(F.col("c_custkey") % 29 != 0).select(
        code("user_", F.col("c_custkey"), 6).alias("user_id"),
        _mapped("c_mktsegment", {
            "BUILDING": "free", "AUTOMOBILE": "free", "MACHINERY": "basic",
            "HOUSEHOLD": "premium", "FURNITURE": "enterprise"}).alias("account_tier"),
        country.alias("registration_country"),
        pick(F.col("c_nationkey") % 10, [COUNTRY_CURRENCY[c] for c in COUNTRIES])
        .alias("preferred_currency"),
        (F.col("c_acctbal") > 0).alias("is_verified"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def profile_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that inserts every profile, updates each third user's tier twice (the first time with
    a change at the same moment that a later one replaces) and deletes each eleventh user."""
    key = F.substring("user_id", 6, 20).cast("long")

    def change(op: str, at: str, seq: int, tier: Column) -> Column:
        when = F.timestamp_add("MINUTE", key % 1000, F.lit(at).cast("timestamp"))
        return F.struct(F.lit(op).alias("op"), when.alias("changed_at"), F.lit(seq).alias("seq"), tier.alias("account_tier"))

    third, eleventh = key % 3 == 0, key % 11 == 0
    feed = F.filter(F.array(
        change("insert", "2024-01-02 00:00:00", 1, F.col("account_tier")),
        F.when(third, change("update", "2024-01-09 06:00:00", 2, F.lit("basic"))),
        F.when(third, change("update", "2024-01-09 06:00:00", 3, F.lit("premium"))),
        F.when(third, change("update", "2024-01-18 06:00:00", 4, F.lit("enterprise"))),
        F.when(eleventh, change("delete", "2024-01-24 06:00:00", 5, F.lit(None).cast("string"))),
    ), lambda c: c.isNotNull())
    rest = ["registration_country", "preferred_currency", "is_verified"]
    return user_profiles(spark, sf_dir).withColumn("change", F.explode(feed)).select(
        "user_id", "change.op", "change.changed_at", "change.seq", "change.account_tier", *rest)


def impression_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages (``event_id``, ``copy``, ``value``) with defects at known event ids."""
    number = F.parse_json(F.col("bid_price").cast("string"))
    quoted = F.parse_json(F.concat(F.lit('"'), F.col("bid_price").cast("string"), F.lit('"')))
    user = F.parse_json(F.concat(F.lit('"'), F.col("user_id"), F.lit('"')))
    message = F.struct(
        F.when(_id() % 79 != 0, F.col("impression_id")).alias("impression_id"),
        F.when(_id() % 59 == 0, F.lit(None))
         .when(F.col("user_id").isNotNull() & (_id() % 73 == 0), F.parse_json(_id().cast("string")))
         .otherwise(user).alias("user_id"),
        "advertiser_id", "campaign_id", "content_id",
        F.when(_id() % 61 == 0, F.parse_json(F.lit("-1")))
         .when(_id() % 71 == 0, quoted).otherwise(number).alias("bid_price"),
        "currency",
        F.when(_id() % 67 == 0, F.lit("KENYA")).otherwise(F.lower("country_code")).alias("country_code"),
        "device_type", "ad_format",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "is_fraud",
    )
    text = F.when(_id() % 53 == 0, F.lit("not json")).otherwise(F.to_json(message))
    return impressions_with_source(spark, sf_dir).select("event_id", "copy", text.alias("value"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(_id() % 100 == 77, F.lit("failed")).when(_id() % 10 <= 6, F.lit("settled"))
        .when(_id() % 10 <= 8, F.lit("pending")).otherwise(F.lit("disputed"))
    )
    return load(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(
        code("pay_", _id(), 10).alias("payment_id"),
        _advertiser().alias("advertiser_id"),
        _campaign().alias("campaign_id"),
        F.round(F.col("value") * 10, 2).alias("amount"),
        pick(_id() % 4, INGEST_CURRENCIES).alias("currency"),
        code("batch_", _id(), 10).alias("impression_batch_id"),
        status.alias("payment_status"),
        F.timestamp_add("HOUR", (_id() % 12).cast("int"), _event_time()).alias("timestamp"),
    )


def engagements(spark: SparkSession, sf_dir: str) -> DataFrame:
    watched = (_id() * 97 % 1801).cast("int")
    return load(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view")).select(
        code("eng_", _id(), 10).alias("engagement_id"),
        code("user_", F.col("user_id"), 6).alias("user_id"),
        _content().alias("content_id"),
        code("imp_", _id(), 10).alias("impression_id"),
        watched.alias("watch_duration_seconds"),
        F.round(watched / 1800, 4).alias("completion_rate"),
        (F.col("event_type") == "click").alias("clicked"),
        F.timestamp_add("SECOND", F.lit(30), _event_time()).alias("timestamp"),
    )


def payment_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment messages; every 13th amount is negated and every 17th status is unknown."""
    return payments(spark, sf_dir).withColumn("event_id", F.substring("payment_id", 5, 40).cast("long")).select(
        "event_id",
        F.to_json(F.struct(
            "payment_id", "advertiser_id", "campaign_id",
            F.when(_id() % 13 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
            "currency", "impression_batch_id",
            F.when(_id() % 17 == 0, F.lit("unknown")).otherwise(F.col("payment_status")).alias("payment_status"),
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        )).alias("value"),
    )


def engagement_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement messages; every 13th completion rate is raised by 1, every 17th has no click."""
    return engagements(spark, sf_dir).withColumn("event_id", F.substring("engagement_id", 5, 40).cast("long")).select(
        "event_id",
        F.to_json(F.struct(
            "engagement_id", "user_id", "content_id", "impression_id", "watch_duration_seconds",
            F.when(_id() % 13 == 0, F.col("completion_rate") + 1.5)
             .otherwise(F.col("completion_rate")).alias("completion_rate"),
            F.when(_id() % 17 != 0, F.col("clicked")).alias("clicked"),
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        )).alias("value"),
    )
