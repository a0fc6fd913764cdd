"""Stateful operators on a stream of impressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlumen.functions.columns import amount, cpm, micros
from adlumen.operators.silver import clean_rows, flag_quality, legitimate_rows


def dedup_stream(impressions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated deliveries that arrive within ``delay`` of the first, in event time.

    State is kept per id for that long only. Copies further apart pass here, unless the later one is
    also late. A row is late if its time is more than ``delay`` before the latest time of an earlier
    batch; late rows are dropped, unique ones too, and counted (``rows_dropped_late``). The ingest
    table holds them all, and deduplication of that table has neither limit. Which copy stays is the
    one that arrives first.
    """
    return impressions.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["impression_id"])


def rows_dropped_late(query: StreamingQuery) -> int:
    """How many rows the query's stateful operators have dropped as late, in the progress it keeps."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress for operator in progress.stateOperators
    )


def served_stream(impressions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Distinct clean legitimate impressions, with a watermark on their time."""
    return legitimate_rows(clean_rows(flag_quality(dedup_stream(impressions, delay))))


def hourly_revenue_stream(impressions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Hourly revenue per advertiser as a stream; an hour is emitted once, when it is complete.

    The same figures as the stored table's, including the exact campaign count: a first window
    per campaign, a second one over its results. Ranks need a whole hour and are left to the table.
    """
    served = served_stream(impressions, delay)
    hour = F.window("timestamp", "1 hour")
    per_campaign = served.groupBy(hour, "advertiser_id", "campaign_id").agg(
        F.sum(micros("bid_price")).alias("spend"),
        F.count("impression_id").alias("impressions"),
        F.count_if(F.col("device_type") == "mobile").alias("mobile"),
        F.count_if(F.col("ad_format") == "video").alias("video"),
    )
    return (
        per_campaign.groupBy(F.window(F.window_time("window"), "1 hour"), "advertiser_id")
        .agg(
            amount(F.sum("spend")).alias("total_spend"),
            F.sum("impressions").alias("impression_count"),
            cpm(F.sum("spend"), F.sum("impressions")).alias("avg_cpm"),
            F.sum("mobile").alias("mobile_impressions"),
            F.sum("video").alias("video_impressions"),
            F.count("campaign_id").alias("unique_campaigns"),
        )
        .select("advertiser_id", F.col("window.start").alias("hour"), "total_spend",
                "impression_count", "avg_cpm", "mobile_impressions", "video_impressions",
                "unique_campaigns")
    )
