"""Queries a revenue dashboard reads from the gold tables.

Rankings list gold rows as they are stored: an advertiser's hour, a content's day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.functions.columns import exact_sum


def _count(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _money(column: str) -> Column:
    return F.coalesce(exact_sum(column), F.lit(0.0))


def dash_summary(content: DataFrame, fraud: DataFrame) -> DataFrame:
    """Key figures over all days, in one row also when a table is empty."""
    served = content.select("total_revenue", "total_impressions", "content_id")
    caught = fraud.select("fraud_impression_count", "fraud_revenue_at_risk")
    return served.unionByName(caught, allowMissingColumns=True).agg(
        F.round(_money("total_revenue"), 2).alias("total_revenue"),
        _count("total_impressions").alias("total_impressions"),
        _count("fraud_impression_count").alias("total_fraud"),
        F.round(_money("fraud_revenue_at_risk"), 4).alias("fraud_revenue_at_risk"),
        F.count_distinct("content_id").alias("active_content"),
    )


def _percent(rate: str) -> Column:
    """A rate of 4 decimals as a percentage of 1, halves rounded up."""
    return F.round(F.rint(F.col(rate) * 10_000) / 100, 1)


def _by_spend(revenue: DataFrame, n: int) -> DataFrame:
    return revenue.orderBy(F.col("total_spend").desc_nulls_last(), "advertiser_id", "hour").limit(n)


def dash_top_advertisers(revenue: DataFrame, n: int = 10) -> DataFrame:
    """The advertiser hours with the highest spend."""
    return _by_spend(revenue, n).select(
        "advertiser_id", "hour", "total_spend", "impression_count", "avg_cpm"
    )


def dash_cpm_top8(revenue: DataFrame) -> DataFrame:
    """CPM of the first eight of the same list."""
    return _by_spend(revenue, 8).select("advertiser_id", "hour", "avg_cpm")


def dash_top_content(content: DataFrame, n: int = 15) -> DataFrame:
    """The content days with the highest revenue, rates shown as percentages."""
    return (
        content.orderBy(F.col("total_revenue").desc_nulls_last(), "content_id", "ingestion_date")
        .limit(n)
        .select(
            "content_id", "ingestion_date", "total_revenue", "total_impressions", "avg_cpm",
            "top_device", "top_country", "top_ad_format",
            _percent("premium_user_rate").alias("premium_user_pct"),
            _percent("verified_user_rate").alias("verified_user_pct"),
        )
    )


def dash_fraud_latest(fraud: DataFrame) -> DataFrame:
    """The most recent day of the fraud summary."""
    return fraud.orderBy(F.col("ingestion_date").desc_nulls_last()).limit(1)


def dash_fraud_rollup(fraud: DataFrame) -> DataFrame:
    """Fraud over all days.

    ``avg_fraud_bid_price`` is the unweighted mean of the daily means, as the dashboard shows it;
    ``weighted_avg_bid_price`` is revenue at risk per fraud impression.
    """
    return fraud.agg(
        _count("fraud_impression_count").alias("fraud_impression_count"),
        F.round(_money("fraud_revenue_at_risk"), 2).alias("fraud_revenue_at_risk"),
        F.round(F.try_divide(exact_sum("avg_fraud_bid_price"), F.count("avg_fraud_bid_price")), 2).alias("avg_fraud_bid_price"),
        F.round(
            F.try_divide(exact_sum("fraud_revenue_at_risk"), F.sum("fraud_impression_count")), 2
        ).alias("weighted_avg_bid_price"),
        F.max("advertisers_targeted").alias("advertisers_targeted"),
        F.max("countries_affected").alias("countries_affected"),
        F.max_by("top_targeted_advertiser", "ingestion_date").alias("top_targeted_advertiser"),
        F.count(F.lit(1)).alias("fraud_days"),
    )


def _revenue_by_top(content: DataFrame, column: str) -> DataFrame:
    return content.groupBy(column).agg(
        F.round(exact_sum("total_revenue"), 2).alias("total_revenue"),
        F.count(F.lit(1)).alias("content_count"),
    )


def dash_device_split(content: DataFrame) -> DataFrame:
    """Revenue of content days by their top device (not by the device that earned it)."""
    return _revenue_by_top(content, "top_device")


def dash_country_revenue(content: DataFrame) -> DataFrame:
    """Revenue of content days by their top country."""
    return _revenue_by_top(content, "top_country")
