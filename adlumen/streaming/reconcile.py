"""Payments reconciled with impressions while both are streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.functions.columns import amount, micros
from adlumen.schemas import RECONCILE_HOURS

_HOUR_MICROS = 3_600_000_000


def payment_reconciliation_stream(payments: DataFrame, impressions: DataFrame, delay: str = "1 hour",
                                  hours: int = RECONCILE_HOURS) -> DataFrame:
    """Number and spend of the impressions that each payment can settle, once all of them are known.

    The streaming form of ``payment_reconciliation``, with the same rows: a payment settles the
    impressions of its advertiser and campaign from ``hours`` before it up to its own time. Both
    streams may be ``delay`` out of order. The join keeps an impression until no payment can ask for
    it any more, and a payment until no impression can come for it; then a payment without any
    leaves the join as well. Its sums are emitted once the watermark of both streams has passed it.

    Rows later than ``delay`` are dropped. Impressions are to have a watermark and to be distinct
    already (``dedup_stream``); payments sent again within ``delay`` count once. Time is cut into
    stretches as long as the span, of which a span touches two: a payment enters the join once for
    each, an impression once. State is keyed by advertiser, campaign and stretch in the join and by
    payment in the sums, so a row meets what is near it in time only, however long the state is kept,
    and a campaign is spread over tasks. Unlike the batch form, which adds up minutes, this one joins
    each payment with its impressions and adds them up behind the join.
    """
    def stretch(at: Column) -> Column:
        return F.floor(F.unix_micros(at) / (max(hours, 1) * _HOUR_MICROS))

    since = F.col("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    facts = ["payment_id", "advertiser_id", "campaign_id", "amount", "payment_status", "timestamp"]
    paid = (
        payments.withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(["payment_id"])
        .select(*facts, F.explode_outer(F.sequence(stretch(since), stretch(F.col("timestamp")))).alias("stretch"))
    )
    seen = impressions.select(
        F.col("advertiser_id").alias("_advertiser"), F.col("campaign_id").alias("_campaign"),
        micros("bid_price").alias("_spend"), F.col("timestamp").alias("_seen"),
        stretch(F.col("timestamp")).alias("_stretch"),
    )
    settles = (
        (F.col("advertiser_id") == F.col("_advertiser")) & (F.col("campaign_id") == F.col("_campaign"))
        & (F.col("stretch") == F.col("_stretch"))
        & (F.col("_seen") >= since) & (F.col("_seen") <= F.col("timestamp"))
    )
    return (
        paid.join(seen, settles, "left_outer")
        .select(*facts, "_advertiser", "_spend")
        .groupBy(*facts)
        .agg(
            F.count("_advertiser").alias("matched_impressions"),
            amount(F.coalesce(F.sum("_spend"), F.lit(0))).alias("matched_spend"),
        )
        .withColumn("reconciled", F.col("matched_impressions") > 0)
    )
