"""Bursts of fraud, drift of bid prices, and distinct counts that can be merged."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlumen.functions.columns import amount, micros

SESSION_GAP_MINUTES = 30
# Relative error of a quantile read from the bins.
PRICE_ERROR = 0.01
MAX_DRIFT = 0.1


def fraud_sessions(fraud: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Bursts of fraud impressions of one user: each at most the gap after the one before.

    Rows of one stretch of time as long as the gap are always of one burst, so they are reduced to
    one row first: a bot with very many impressions is sorted by stretches, not by rows.
    """
    gap = gap_minutes * 60_000_000
    at = F.unix_micros("timestamp")
    stretches = (
        fraud.where(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy("user_id", F.floor(at / gap).alias("stretch"))
        .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("n"), F.sum(micros("bid_price")).alias("spend"))
    )
    by_time = Window.partitionBy("user_id").orderBy("stretch")
    waited = F.unix_micros("first") - F.unix_micros(F.lag("last").over(by_time))
    numbered = stretches.withColumn("begins", F.when(waited <= gap, 0).otherwise(1)).withColumn("burst", F.sum("begins").over(by_time))
    return numbered.groupBy("user_id", "burst").agg(
        F.min("first").alias("started"), F.max("last").alias("ended"),
        F.sum("n").alias("impressions"), amount(F.sum("spend")).alias("revenue_at_risk"),
    ).drop("burst")


def fraud_sessions_stream(fraud: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """The same bursts from a stream with a watermark, each when no more can join it."""
    session = F.session_window("timestamp", f"{gap_minutes} minutes")
    return fraud.where(F.col("user_id").isNotNull()).groupBy("user_id", session).agg(
        F.min("timestamp").alias("started"), F.max("timestamp").alias("ended"),
        F.count(F.lit(1)).alias("impressions"), amount(F.sum(micros("bid_price"))).alias("revenue_at_risk"),
    ).drop("session_window")


# --- drift --------------------------------------------------------------------------------


_GAMMA = (1 + PRICE_ERROR) / (1 - PRICE_ERROR)


def price_bins(impressions: DataFrame) -> DataFrame:
    """A mergeable sketch of each day's bid prices: how many fall into bins of equal relative width.

    Bins of several days, batches or tables are merged by adding up their counts; any quantile read
    from them is within ``PRICE_ERROR`` of an exact one, relative to its size. Prices that are
    missing, not positive or not finite are in no bin.
    """
    priced = impressions.where((F.col("bid_price") > 0) & (F.col("bid_price") < float("inf")))
    bin_ = F.ceil(F.log("bid_price") / math.log(_GAMMA)).alias("bin")
    return priced.groupBy("ingestion_date", bin_).agg(F.count(F.lit(1)).alias("n"))


def _price_of(bin_: Column) -> Column:
    """The price in a bin that is nearest to all of it, relatively."""
    return 2 * F.pow(F.lit(_GAMMA), bin_) / (_GAMMA + 1)


def bid_price_drift(bins: DataFrame, limit: float = MAX_DRIFT) -> DataFrame:
    """Each day's median and 95 % price, and how far its prices are from the day before.

    ``distance`` is the largest difference between the shares of the two days' prices below any bin
    edge (0 to 1); a day fails if it is above ``limit``. The first day has none and passes.
    """
    days = bins.select("ingestion_date").distinct()
    before = days.withColumn("next", F.lead("ingestion_date").over(Window.orderBy("ingestion_date")))  # one row a day
    reference = bins.join(before, "ingestion_date").where("next is not null").select(F.col("next").alias("ingestion_date"), "bin", F.lit(0).cast("long").alias("n"), F.col("n").alias("before"))
    both = bins.withColumn("before", F.lit(0).cast("long")).unionByName(reference).groupBy("ingestion_date", "bin").agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
    day = Window.partitionBy("ingestion_date")
    up_to = day.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    shares = both.select(
        "ingestion_date", "bin", F.sum("n").over(day).alias("total"), F.sum("n").over(up_to).alias("below"),
        F.sum("before").over(day).alias("total_before"), F.sum("before").over(up_to).alias("below_before"),
    )
    apart = F.abs(F.col("below") / F.col("total") - F.try_divide(F.col("below_before"), F.col("total_before")))

    def quantile(share: float) -> Column:
        return F.round(_price_of(F.min(F.when(F.col("below") >= share * F.col("total"), F.col("bin")))), 4)

    return shares.groupBy("ingestion_date").agg(
        F.max("total").alias("prices"), quantile(0.5).alias("median_price"), quantile(0.95).alias("p95_price"),
        F.round(F.max(apart), 6).alias("distance"),
    ).withColumn("within_limit", F.coalesce(F.col("distance") <= limit, F.lit(True)))


# --- distinct counts ----------------------------------------------------------------------

# 2 ** 14 registers: a standard error of 0.65 %, and exact up to a few hundred values.
SKETCH_BITS = 14
COUNTED = ["user_id", "advertiser_id", "campaign_id", "content_id"]


def distinct_sketches(legitimate: DataFrame) -> DataFrame:
    """For each day a sketch of the distinct users, advertisers, campaigns and contents.

    Exact distinct counts of days cannot be added; sketches of days, or of parts of a day, can be
    united in any order.
    """
    return legitimate.groupBy("ingestion_date").agg(*[F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{c}_sketch") for c in COUNTED])


def distinct_over_range(sketches: DataFrame) -> DataFrame:
    """Estimated distinct counts over all days of ``sketches``, with their relative standard error."""
    return sketches.agg(
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(f"{c}_count") for c in COUNTED]
    ).withColumn("standard_error", F.lit(round(0.8326 / 2 ** (SKETCH_BITS / 2), 4)))
