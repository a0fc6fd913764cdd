"""Table schemas, vocabularies and thresholds.

Everything here is a fixed value of the data contract; no logic lives in this module.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

# --- fixed values -------------------------------------------------------------------------

# Currencies an event may carry at ingest. The silver layer knows a longer list on purpose.
INGEST_CURRENCIES = ["USD", "EUR", "GBP", "KES"]
SILVER_CURRENCIES = ["USD", "EUR", "GBP", "KES", "NGN", "ZAR", "INR", "BRL", "CAD"]
COUNTRIES = ["US", "GB", "KE", "DE", "FR", "NG", "ZA", "IN", "BR", "CA"]
COUNTRY_CURRENCY = {
    "US": "USD", "GB": "GBP", "KE": "KES", "DE": "EUR", "FR": "EUR",
    "NG": "NGN", "ZA": "ZAR", "IN": "INR", "BR": "BRL", "CA": "CAD",
}
DEVICES = ["mobile", "desktop", "tablet", "ctv"]
AD_FORMATS = ["banner", "video", "native", "audio"]
PAYMENT_STATUSES = ["pending", "settled", "failed", "disputed"]
PREMIUM_TIERS = ["premium", "enterprise"]

MAX_BID_PRICE = 50.0
MAX_FRAUD_RATE = 0.10
MAX_NULL_RATE = 0.05

# A payment settles the impressions of its advertiser and campaign seen in the hours before it.
RECONCILE_HOURS = 6

IMPRESSION_TOPIC = "ad.impressions.raw"

# --- schemas ------------------------------------------------------------------------------

# All columns are nullable, as stored files are.

_IMPRESSION = [
    StructField("impression_id", StringType()),
    StructField("user_id", StringType()),
    StructField("advertiser_id", StringType()),
    StructField("campaign_id", StringType()),
    StructField("content_id", StringType()),
    StructField("bid_price", DoubleType()),
    StructField("currency", StringType()),
    StructField("country_code", StringType()),
    StructField("device_type", StringType()),
    StructField("ad_format", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("is_fraud", BooleanType()),
]
_PROFILE = [
    StructField("account_tier", StringType()),
    StructField("registration_country", StringType()),
    StructField("preferred_currency", StringType()),
    StructField("is_verified", BooleanType()),
]

IMPRESSION_SCHEMA = StructType(list(_IMPRESSION))
BRONZE_SCHEMA = StructType([*_IMPRESSION, StructField("ingestion_date", DateType())])
PROFILE_SCHEMA = StructType([
    StructField("user_id", StringType()),
    *_PROFILE,
    StructField("created_at", TimestampType()),
])
PAYMENT_SCHEMA = StructType([
    StructField("payment_id", StringType()),
    StructField("advertiser_id", StringType()),
    StructField("campaign_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("impression_batch_id", StringType()),
    StructField("payment_status", StringType()),
    StructField("timestamp", TimestampType()),
])
ENGAGEMENT_SCHEMA = StructType([
    StructField("engagement_id", StringType()),
    StructField("user_id", StringType()),
    StructField("content_id", StringType()),
    StructField("impression_id", StringType()),
    StructField("watch_duration_seconds", IntegerType()),
    StructField("completion_rate", DoubleType()),
    StructField("clicked", BooleanType()),
    StructField("timestamp", TimestampType()),
])
# All outcomes of a layer are stored in one location, partitioned by outcome. ``position`` is where
# a message stood in its topic.
INGEST_SCHEMA = StructType([
    *_IMPRESSION,
    StructField("value", StringType()),
    StructField("errors", ArrayType(StringType())),
    StructField("position", StringType()),
    StructField("outcome", StringType()),
    StructField("ingestion_date", DateType()),
    StructField("source", StringType()),
    StructField("batch_id", StringType()),
])
# What each stored batch holds; ``version`` is new with every write of the batch.
COUNTS_SCHEMA = StructType([
    StructField("outcome", StringType()),
    StructField("ingestion_date", DateType()),
    StructField("rows", LongType()),
    StructField("fraud_rows", LongType()),
    StructField("version", StringType()),
    StructField("source", StringType()),
    StructField("batch_id", StringType()),
])
# Which versions gold holds: +1 when their day was computed with them, -1 when it was without.
APPLIED_SCHEMA = StructType([
    StructField("version", StringType()),
    StructField("ingestion_date", DateType()),
    StructField("change", IntegerType()),
])
# Which state of a day a layout is a copy of: +1 when it was completed, -1 when it was removed.
COMPACTION_SCHEMA = StructType([
    StructField("ingestion_date", DateType()),
    StructField("layout", StringType()),
    StructField("state", LongType()),
    StructField("change", IntegerType()),
])
SILVER_SCHEMA = StructType([
    *_IMPRESSION,
    *_PROFILE,
    StructField("quality_issues", StringType()),
    StructField("outcome", StringType()),
    StructField("ingestion_date", DateType()),
])

IMPRESSION_COLUMNS = IMPRESSION_SCHEMA.fieldNames()
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()
PROFILE_COLUMNS = [f.name for f in _PROFILE]

# user_id leads because the profile join is a USING join on it.
SILVER_COLUMNS = (
    ["user_id"] + [c for c in BRONZE_COLUMNS if c != "user_id"] + PROFILE_COLUMNS
)
QUARANTINE_COLUMNS = BRONZE_COLUMNS + ["quality_issues"]

REVENUE_COLUMNS = [
    "advertiser_id", "hour", "total_spend", "impression_count", "avg_cpm",
    "mobile_impressions", "video_impressions", "unique_campaigns", "ingestion_date",
    "spend_rank_in_hour",
]
CONTENT_COLUMNS = [
    "content_id", "ingestion_date", "total_impressions", "total_revenue", "avg_cpm",
    "premium_user_rate", "verified_user_rate", "top_device", "top_country", "top_ad_format",
]
FRAUD_COLUMNS = [
    "ingestion_date", "fraud_impression_count", "fraud_revenue_at_risk",
    "avg_fraud_bid_price", "advertisers_targeted", "countries_affected",
    "top_targeted_advertiser",
]
