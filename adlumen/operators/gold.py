"""Silver to gold: hourly revenue, daily content performance, daily fraud.

Every aggregate first reduces its rows to additive partials (sums and counts) at the finest grain
it needs. Spark combines those in each map task, so a key that holds a large share of all rows
costs one partial row per task. Everything after reads only the partials.

Amounts are added up across currencies without conversion; bid_price is one unit to all tables.
They are summed in whole millionths, so results do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlumen.functions.columns import amount, cpm, mean_amount, micros, most_frequent
from adlumen.schemas import CONTENT_COLUMNS, FRAUD_COLUMNS, PREMIUM_TIERS, REVENUE_COLUMNS
_CONTENT_DAY = ["content_id", "ingestion_date"]


def _rows() -> Column:
    return F.count(F.lit(1))


# --- hourly revenue -----------------------------------------------------------------------


def hourly_revenue(legitimate: DataFrame) -> DataFrame:
    """Spend, impressions and campaigns per advertiser and hour, not yet ranked.

    Grouping by campaign first turns the distinct count into a plain count of partial rows.
    """
    per_campaign = (
        legitimate.groupBy(
            "advertiser_id", F.date_trunc("hour", "timestamp").alias("hour"), "campaign_id"
        )
        .agg(
            F.sum(micros("bid_price")).alias("spend"),
            F.count("impression_id").alias("impressions"),
            F.count_if(F.col("device_type") == "mobile").alias("mobile"),
            F.count_if(F.col("ad_format") == "video").alias("video"),
        )
    )
    return (
        per_campaign.groupBy("advertiser_id", "hour")
        .agg(
            amount(F.sum("spend")).alias("total_spend"),
            F.sum("impressions").alias("impression_count"),
            cpm(F.sum("spend"), F.sum("impressions")).alias("avg_cpm"),
            F.sum("mobile").alias("mobile_impressions"),
            F.sum("video").alias("video_impressions"),
            F.count("campaign_id").alias("unique_campaigns"),
        )
        .withColumn("ingestion_date", F.to_date("hour"))
    )


def revenue_by_advertiser(legitimate: DataFrame) -> DataFrame:
    """Hourly revenue with each advertiser's rank in the hour, by rounded spend, ties equal.

    The window sorts one row per advertiser of an hour, however many impressions the hour had.
    """
    by_spend = Window.partitionBy("hour").orderBy(F.col("total_spend").desc_nulls_last())
    return (
        hourly_revenue(legitimate)
        .withColumn("spend_rank_in_hour", F.rank().over(by_spend))
        .select(*REVENUE_COLUMNS)
    )


# --- daily content ------------------------------------------------------------------------


def _content_partials(legitimate: DataFrame) -> DataFrame:
    return legitimate.groupBy(*_CONTENT_DAY, "device_type", "country_code", "ad_format").agg(
        _rows().alias("rows"),
        F.count("impression_id").alias("impressions"),
        F.sum(micros("bid_price")).alias("revenue"),
        F.count_if(F.col("account_tier").isin(PREMIUM_TIERS)).alias("premium"),
        F.count_if("is_verified").alias("verified"),
    )


_CONTENT_SUMS = ["rows", "impressions", "revenue", "premium", "verified"]


def _content_metrics() -> dict:
    return {
        "total_impressions": F.col("impressions"),
        "total_revenue": amount(F.col("revenue")),
        "avg_cpm": cpm(F.col("revenue"), F.col("impressions")),
        # Viewers without a profile count as neither premium nor verified.
        "premium_user_rate": F.round(F.col("premium") / F.col("rows"), 4),
        "verified_user_rate": F.round(F.col("verified") / F.col("rows"), 4),
    }


def content_core(legitimate: DataFrame) -> DataFrame:
    """Impressions, revenue and viewer rates per content and day."""
    sums = legitimate.groupBy(*_CONTENT_DAY).agg(
        _rows().alias("rows"),
        F.count("impression_id").alias("impressions"),
        F.sum(micros("bid_price")).alias("revenue"),
        F.count_if(F.col("account_tier").isin(PREMIUM_TIERS)).alias("premium"),
        F.count_if("is_verified").alias("verified"),
    )
    return sums.select(*_CONTENT_DAY, *[c.alias(n) for n, c in _content_metrics().items()])


def _content_top(legitimate: DataFrame, column: str, name: str) -> DataFrame:
    return (
        legitimate.groupBy(*_CONTENT_DAY, column).agg(_rows().alias("rows"))
        .groupBy(*_CONTENT_DAY).agg(most_frequent(column, F.col("rows")).alias(name))
    )


def content_top_device(legitimate: DataFrame) -> DataFrame:
    return _content_top(legitimate, "device_type", "top_device")


def content_top_country(legitimate: DataFrame) -> DataFrame:
    return _content_top(legitimate, "country_code", "top_country")


def content_top_format(legitimate: DataFrame) -> DataFrame:
    return _content_top(legitimate, "ad_format", "top_ad_format")


def content_performance(legitimate: DataFrame) -> DataFrame:
    """Core metrics and the most frequent device, country and format per content and day.

    One pass over the impressions: the partials are rolled up to the day and to each of the three
    categories with grouping sets, and the day's row is put together from those by one more
    aggregate. There is no join. A row with a NULL content or day has no top values.
    """
    level_of = {"day": 0b00111, "device_type": 0b00011, "country_code": 0b00101, "ad_format": 0b00110}
    levels = (
        _content_partials(legitimate)
        .groupingSets(
            [_CONTENT_DAY, *[[*_CONTENT_DAY, c] for c in level_of if c != "day"]],
            *_CONTENT_DAY, "device_type", "country_code", "ad_format",
        )
        .agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in _CONTENT_SUMS])
    )
    at = {name: F.col("level") == level for name, level in level_of.items()}
    day = levels.groupBy(*_CONTENT_DAY).agg(
        *[F.max(F.when(at["day"], F.col(c))).alias(c) for c in _CONTENT_SUMS],
        *[most_frequent(c, F.col("rows"), at[c]).alias(f"top_{c}") for c in level_of if c != "day"],
    )
    keyed = F.col("content_id").isNotNull() & F.col("ingestion_date").isNotNull()
    return day.select(
        *_CONTENT_DAY,
        *[c.alias(name) for name, c in _content_metrics().items()],
        F.when(keyed, F.col("top_device_type")).alias("top_device"),
        F.when(keyed, F.col("top_country_code")).alias("top_country"),
        F.when(keyed, F.col("top_ad_format")).alias("top_ad_format"),
    ).select(*CONTENT_COLUMNS)


# --- daily fraud --------------------------------------------------------------------------


def _fraud_partials(fraud: DataFrame) -> DataFrame:
    return fraud.groupBy("ingestion_date", "advertiser_id", "country_code").agg(
        _rows().alias("rows"),
        F.count("impression_id").alias("impressions"),
        F.sum(micros("bid_price")).alias("revenue"),
        F.count("bid_price").alias("priced"),
    )


def _fraud_by_day(fraud: DataFrame) -> DataFrame:
    """Daily totals, distinct advertisers and countries, and the top advertiser in one pass."""
    sums = ["rows", "impressions", "revenue", "priced"]
    day, advertiser, country = 0b011, 0b001, 0b010
    levels = (
        _fraud_partials(fraud)
        .groupingSets(
            [["ingestion_date"], ["ingestion_date", "advertiser_id"],
             ["ingestion_date", "country_code"]],
            "ingestion_date", "advertiser_id", "country_code",
        )
        .agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in sums])
    )
    level = F.col("level")
    return levels.groupBy("ingestion_date").agg(
        F.max(F.when(level == day, F.col("impressions"))).alias("fraud_impression_count"),
        F.max(F.when(level == day, amount(F.col("revenue")))).alias("fraud_revenue_at_risk"),
        F.max(F.when(level == day, mean_amount(F.col("revenue"), F.col("priced"))))
         .alias("avg_fraud_bid_price"),
        F.count_if((level == advertiser) & F.col("advertiser_id").isNotNull())
         .alias("advertisers_targeted"),
        F.count_if((level == country) & F.col("country_code").isNotNull())
         .alias("countries_affected"),
        most_frequent("advertiser_id", F.col("rows"), level == advertiser)
         .alias("top_targeted_advertiser"),
    )


def fraud_daily(fraud: DataFrame) -> DataFrame:
    """Daily totals of the fraud table."""
    return _fraud_by_day(fraud).drop("top_targeted_advertiser")


def fraud_top_advertiser(fraud: DataFrame) -> DataFrame:
    """The advertiser with most fraud impressions per day."""
    return (
        fraud.groupBy("ingestion_date", "advertiser_id").agg(_rows().alias("rows"))
        .groupBy("ingestion_date")
        .agg(most_frequent("advertiser_id", F.col("rows")).alias("top_targeted_advertiser"))
    )


def fraud_summary(fraud: DataFrame) -> DataFrame:
    """Daily totals with the most targeted advertiser; a NULL day has none."""
    return (
        _fraud_by_day(fraud)
        .withColumn(
            "top_targeted_advertiser",
            F.when(F.col("ingestion_date").isNotNull(), F.col("top_targeted_advertiser")),
        )
        .select(*FRAUD_COLUMNS)
    )


def fraud_by_country(fraud: DataFrame) -> DataFrame:
    """Drill-down of the fraud totals by day and country."""
    return fraud.groupBy("ingestion_date", "country_code").agg(
        F.count("impression_id").alias("fraud_impression_count"),
        amount(F.sum(micros("bid_price"))).alias("fraud_revenue_at_risk"),
    )
