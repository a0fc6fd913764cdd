"""Payments and engagements linked to the impressions they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlumen.functions.columns import amount, exact_sum, micros, whole
from adlumen.operators.silver import dedup_first
from adlumen.schemas import RECONCILE_HOURS

_MINUTE_MICROS = 60_000_000
_PAIR = ["advertiser_id", "campaign_id"]


def payment_reconciliation(payments: DataFrame, impressions: DataFrame,
                           hours: int = RECONCILE_HOURS) -> DataFrame:
    """Number and spend of the impressions each payment can settle.

    A payment settles impressions of its advertiser and campaign from ``hours`` before it up to
    its own time, both ends included. Pairing payments with impressions would multiply them, so
    the sums are put together from three parts, none of which pairs rows:

    * whole minutes inside the span, from per-minute totals of each advertiser and campaign;
    * the payment's own minute, up to the payment;
    * the span's first minute, from its start on.

    The window over per-minute totals has at most one row per minute of a campaign, whatever its
    traffic; the two edges sort the impressions of one campaign and minute at a time.
    """
    def minute_and_offset() -> list[Column]:
        micros = F.unix_micros("timestamp")
        offset = F.pmod(micros, F.lit(_MINUTE_MICROS))
        minute = ((micros - offset) / _MINUTE_MICROS).cast("long")
        return [minute.alias("minute"), offset.alias("offset")]

    paid = dedup_first(payments, "payment_id").select(
        "payment_id", *_PAIR, "amount", "payment_status", "timestamp",
        *minute_and_offset(),
    )
    seen = impressions.dropna(subset=[*_PAIR, "timestamp"]).select(
        *_PAIR, micros("bid_price").alias("spend"),
        *minute_and_offset(),
    )
    return _reconcile(paid, seen, span=hours * 60)


def _reconcile(paid: DataFrame, seen: DataFrame, span: int) -> DataFrame:
    # Payments without advertiser, campaign or time match nothing and would only pile up.
    matchable = paid.dropna(subset=[*_PAIR, "minute"])
    # Whole minutes. Minutes that only have payments enter with zero, to be looked up later.
    per_minute = (
        seen.select(*_PAIR, "minute", F.lit(1).alias("n"), "spend")
        .unionByName(matchable.select(*_PAIR, "minute", F.lit(0).alias("n"), F.lit(0).cast("long").alias("spend")))
        .groupBy(*_PAIR, "minute").agg(F.sum("n").alias("n"), F.sum("spend").alias("spend"))
    )
    inside = Window.partitionBy(*_PAIR).orderBy("minute").rangeBetween(-(span - 1), -1)
    whole_minutes = per_minute.select(
        *_PAIR, "minute", F.sum("n").over(inside).alias("n"), F.sum("spend").over(inside).alias("spend")
    ).where("n > 0")

    # Edges. A payment puts one mark into its own minute and one into the span's first minute.
    marks = matchable.select(
        "payment_id", *_PAIR, "offset",
        F.explode(F.array(
            F.struct(F.lit("last").alias("edge"), F.col("minute").alias("minute")),
            F.struct(F.lit("first").alias("edge"), (F.col("minute") - span).alias("minute")),
        )).alias("mark"),
    ).select("payment_id", *_PAIR, "offset", "mark.edge", "mark.minute")
    in_minute = seen.select(*_PAIR, "minute", "offset", F.lit(1).alias("n"), "spend")
    both = in_minute.unionByName(marks, allowMissingColumns=True)
    frame = Window.partitionBy(*_PAIR, "minute")
    up_to = frame.orderBy("offset").rangeBetween(Window.unboundedPreceding, 0)
    from_on = frame.orderBy(F.col("offset").desc()).rangeBetween(Window.unboundedPreceding, 0)
    last, first = F.col("edge") == "last", F.col("edge") == "first"
    edges = (
        both.select(
            "payment_id", "edge",
            F.sum("n").over(up_to).alias("n_up_to"), F.sum("spend").over(up_to).alias("spend_up_to"),
            F.sum("n").over(from_on).alias("n_from"), F.sum("spend").over(from_on).alias("spend_from"),
        )
        .where(F.col("edge").isNotNull())
        .select(
            "payment_id",
            F.when(last, F.col("n_up_to")).when(first, F.col("n_from")).alias("n"),
            F.when(last, F.col("spend_up_to")).when(first, F.col("spend_from")).alias("spend"),
        )
    )

    facts = ["payment_id", *_PAIR, "amount", "payment_status", "timestamp"]
    middle = paid.join(whole_minutes, [*_PAIR, "minute"], "left").select(*facts, "n", "spend")
    return (
        middle.unionByName(edges, allowMissingColumns=True)
        .groupBy("payment_id")
        .agg(
            *[F.max(c).alias(c) for c in facts if c != "payment_id"],
            F.coalesce(F.sum("n"), F.lit(0)).alias("matched_impressions"),
            amount(F.coalesce(F.sum("spend"), F.lit(0))).alias("matched_spend"),
        )
        .withColumn("reconciled", F.col("matched_impressions") > 0)
    )


def engagement_by_content(engagements: DataFrame, impressions: DataFrame) -> DataFrame:
    """Viewing behaviour per content, over all its impressions.

    Engagements arrive at least once: of those that share an id the earliest counts, on a tie the
    smallest; each one without an id counts. They are reduced to one row per impression before the
    join, so an impression with very many of them joins as a single row.
    """
    values = ["impression_id", "watch_duration_seconds", "completion_rate", "clicked"]
    sent = engagements.where(F.col("impression_id").isNotNull()).select("engagement_id", "timestamp", *values)
    once = (
        sent.where(F.col("engagement_id").isNotNull()).groupBy("engagement_id")
        .agg(F.min(F.struct("timestamp", *values)).alias("first"))
        .select(*[F.col(f"first.{c}").alias(c) for c in values])
    )
    per_impression = (
        once.unionByName(sent.where(F.col("engagement_id").isNull()).select(*values))
        .groupBy("impression_id")
        .agg(
            F.count(F.lit(1)).alias("engagements"),
            F.sum("watch_duration_seconds").alias("watch_seconds"),
            exact_sum("completion_rate").alias("completion"),
            F.count(whole("completion_rate")).alias("completions"),
            F.count_if("clicked").alias("clicks"),
        )
    )
    return (
        impressions.select("impression_id", "content_id")
        .join(per_impression, "impression_id", "left")
        .groupBy("content_id")
        .agg(
            F.count(F.lit(1)).alias("impressions"),
            F.coalesce(F.sum("engagements"), F.lit(0)).alias("engagements"),
            F.coalesce(F.sum("watch_seconds"), F.lit(0)).alias("watch_seconds"),
            F.round(F.try_divide(exact_sum("completion"), F.sum("completions")), 4)
             .alias("avg_completion_rate"),
            F.round(F.coalesce(F.sum("clicks"), F.lit(0)) / F.count(F.lit(1)), 4).alias("click_rate"),
        )
    )
