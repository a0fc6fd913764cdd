"""The keys with the most spend over a stream, from summaries of bounded size.

A batch leaves its exact spend of each key, sorted by key, and a summary: its largest keys by name
and, for all others, what the largest of them spent. Summaries of any batches merge into one of the
same form. In it a key's spend is at least what the summaries that name it tell, and at most that
plus the rest of those that do not, so the bounds tell which keys can be among the largest. Only
these are looked up in the exact spends, and if a key without a name could be, all are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlumen.functions.columns import amount, micros

# Keys that a summary names.
SUMMARY_SIZE = 1000
_SPENT = "key STRING, spend LONG, impressions LONG, batch LONG"
_SUMMARY = "key STRING, spend LONG, slack LONG, is_rest BOOLEAN, batch LONG"


def spend_by_key(impressions: DataFrame, key: str) -> DataFrame:
    """Exact spend in micros and impressions of each key. Impressions without a key count nowhere;
    prices that are missing, not positive or not finite spend nothing."""
    price = F.when((F.col("bid_price") > 0) & (F.col("bid_price") < float("inf")), micros("bid_price"))
    return impressions.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.coalesce(F.sum(price), F.lit(0)).cast("long").alias("spend"), F.count(F.lit(1)).alias("impressions"))


def _limited(bounds: DataFrame, rest: int, size: int) -> DataFrame:
    """A summary of ``bounds (key, spend, slack)``, of which keys without a name spend up to ``rest``."""
    largest = (F.col("spend") + F.col("slack")).desc(), F.col("key")
    first = bounds.orderBy(*largest).limit(size + 1).withColumn("place", F.row_number().over(Window.orderBy(*largest)))
    named = first.where(F.col("place") <= size).select("key", "spend", "slack", F.lit(False).alias("is_rest"))
    left_out = F.max(F.when(F.col("place") > size, F.col("spend") + F.col("slack")))
    others = first.agg(F.lit(None).cast("string").alias("key"), F.greatest(left_out, F.lit(rest)).cast("long").alias("spend"), F.lit(0).cast("long").alias("slack"), F.lit(True).alias("is_rest"))
    return named.unionByName(others)


def summary(spent: DataFrame, size: int = SUMMARY_SIZE) -> DataFrame:
    """The summary of one batch's exact spends: key, spend, slack (0), is_rest."""
    return _limited(spent.select("key", "spend", F.lit(0).cast("long").alias("slack")), 0, size)


def _rest(summaries: DataFrame) -> int:
    """What a key that no summary names can have spent."""
    return summaries.where("is_rest").agg(F.coalesce(F.sum("spend"), F.lit(0)).alias("n")).first().n


def bounds(summaries: DataFrame) -> DataFrame:
    """Each named key with the least it spent and the slack up to the most, over several summaries
    told apart by ``batch``."""
    rest = summaries.where("is_rest").select("batch", F.col("spend").alias("left"))
    named = summaries.where("not is_rest").join(rest, "batch", "left")
    return named.groupBy("key").agg(
        F.sum("spend").alias("spend"), (F.sum("slack") + F.lit(_rest(summaries)) - F.sum(F.coalesce("left", F.lit(0)))).alias("slack"))


def merged(summaries: DataFrame, size: int = SUMMARY_SIZE) -> DataFrame:
    """One summary in place of several; its bounds hold the exact spends as theirs do."""
    return _limited(bounds(summaries), _rest(summaries), size)


def store_batch(impressions: DataFrame, batch: int, root: str, key: str, size: int = SUMMARY_SIZE) -> None:
    """Store a batch's spends and summary; writing a batch again replaces both."""
    spark = impressions.sparkSession
    spent = f"{root}/spent/batch={batch}"
    spend_by_key(impressions, key).sortWithinPartitions("key").write.mode("overwrite").parquet(spent)
    stored = spark.read.schema("key STRING, spend LONG, impressions LONG").parquet(spent)
    summary(stored, size).coalesce(1).write.mode("overwrite").parquet(f"{root}/summaries/batch={batch}")


def start_leaders(impressions: DataFrame, root: str, checkpoint: str, key: str = "advertiser_id", size: int = SUMMARY_SIZE) -> StreamingQuery:
    """Keep spends and summaries of all batches that are there, and end."""
    return (
        impressions.writeStream.foreachBatch(lambda rows, batch: store_batch(rows, batch, root, key, size))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_SUMMARY).parquet(f"{root}/summaries")


def candidates(summaries: DataFrame, n: int) -> DataFrame | None:
    """The keys that can be among the ``n`` largest; None if a key without a name can be, too."""
    known = bounds(summaries)
    least = known.orderBy(F.desc("spend")).limit(n).agg(F.min("spend").alias("least"), F.count(F.lit(1)).alias("n")).first()
    if least.n < n or _rest(summaries) >= least.least:
        return None
    return known.where(F.col("spend") + F.col("slack") >= F.lit(least.least)).select("key")


def leaders(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """The exact ``n`` keys with the most spend over all stored batches, ties by key: key,
    total_spend, impression_count."""
    spent = spark.read.schema(_SPENT).parquet(f"{root}/spent")
    able = candidates(read_summaries(spark, root), n)
    if able is not None:
        spent = spent.join(able, "key", "left_semi")
    totals = spent.groupBy("key").agg(F.sum("spend").alias("spend"), F.sum("impressions").alias("impression_count"))
    return totals.orderBy(F.desc("spend"), "key").limit(n).select("key", amount(F.col("spend")).alias("total_spend"), "impression_count")
