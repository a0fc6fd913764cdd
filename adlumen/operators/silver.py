"""Bronze to silver: deduplicate, flag quality, add profiles, separate fraud.

The order matters and is fixed: a bad copy that arrives first wins over a good later one, because
deduplication comes before the quality check.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlumen.functions.columns import quality_issues, rate
from adlumen.schemas import PROFILE_COLUMNS, QUARANTINE_COLUMNS, SILVER_COLUMNS


class Silver(NamedTuple):
    legitimate: DataFrame
    fraud: DataFrame
    quarantine: DataFrame


def dedup_first(rows: DataFrame, key: str, time_col: str = "timestamp") -> DataFrame:
    """One row per key: the earliest, ties broken by the remaining columns.

    NULL counts as one key. Spark plans the rank-1 filter with a partial group limit before the
    shuffle, so each map task sends at most one row per key and a key that holds a large share of
    the input does not end up in one task.
    """
    rest = [c for c in rows.columns if c not in (key, time_col)]
    earliest = Window.partitionBy(key).orderBy(
        F.col(time_col).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]
    )
    return (
        rows.withColumn("_copy", F.row_number().over(earliest)).where("_copy = 1").drop("_copy")
    )


def dedup_impressions(impressions: DataFrame) -> DataFrame:
    return dedup_first(impressions, "impression_id")


def dedup_stats(impressions: DataFrame) -> DataFrame:
    """One row: rows before and after deduplication, and their difference."""
    per_id = impressions.groupBy("impression_id").agg(F.count(F.lit(1)).alias("copies"))
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def flag_quality(impressions: DataFrame) -> DataFrame:
    return impressions.withColumn("quality_issues", quality_issues())


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("quality_issues") == "").drop("quality_issues")


def quarantined_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("quality_issues") != "").select(*QUARANTINE_COLUMNS)


def quality_stats(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count_if(F.col("quality_issues") == "").alias("clean"),
        F.count_if(F.col("quality_issues") != "").alias("quarantined"),
    )


def quarantine_sample(flagged: DataFrame, n: int = 3) -> DataFrame:
    """A few quarantined rows for a log or alert, the same ones on every run."""
    return (
        quarantined_rows(flagged).select("impression_id", "quality_issues")
        .orderBy("impression_id", "quality_issues").limit(n)
    )


def enrich(impressions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join of the profile columns on user_id; impressions without a profile keep NULLs.

    No broadcast is forced, because the profile table grows with the users. Spark broadcasts it
    when its estimated or, after its own stage, measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join is shuffled, and adaptive
    execution splits the partitions of users with very many impressions.
    """
    return impressions.join(
        profiles.select("user_id", *PROFILE_COLUMNS), "user_id", "left"
    )


def missing_profiles(impressions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Impressions whose user has no profile."""
    return impressions.join(profiles.select("user_id"), "user_id", "left_anti")


def duplicate_profiles(profiles: DataFrame) -> DataFrame:
    """User ids that occur more than once; each would multiply that user's impressions."""
    return (
        profiles.groupBy("user_id").agg(F.count(F.lit(1)).alias("profiles"))
        .where("profiles > 1")
    )


def enrich_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("account_tier").isNull()).alias("missing_profiles"),
    )


def legitimate_rows(enriched: DataFrame) -> DataFrame:
    return enriched.where("NOT is_fraud")


def fraud_rows(enriched: DataFrame) -> DataFrame:
    return enriched.where("is_fraud")


def split_stats(enriched: DataFrame) -> DataFrame:
    """Sizes of the split; ``unflagged`` rows (NULL is_fraud) belong to neither side."""
    counts = enriched.agg(
        F.count_if(~F.col("is_fraud")).alias("legitimate"),
        F.count_if("is_fraud").alias("fraud"),
        F.count_if(F.col("is_fraud").isNull()).alias("unflagged"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(
        "legitimate", "fraud", "unflagged",
        rate(F.col("fraud"), F.col("total")).alias("fraud_rate"),
    )


def silver(bronze: DataFrame, profiles: DataFrame) -> Silver:
    """The three silver tables as lazy frames."""
    flagged = flag_quality(dedup_impressions(bronze))
    enriched = enrich(clean_rows(flagged), profiles).select(*SILVER_COLUMNS)
    return Silver(legitimate_rows(enriched), fraud_rows(enriched), quarantined_rows(flagged))


def without_earlier(impressions: DataFrame, earlier: DataFrame) -> DataFrame:
    """Impressions whose id no row of ``earlier`` has; of that only the ids are read."""
    ids = earlier.select(F.col("impression_id").alias("_earlier"))
    return impressions.join(ids, F.col("impression_id").eqNullSafe(F.col("_earlier")), "left_anti")


def silver_outcomes(bronze: DataFrame, profiles: DataFrame) -> DataFrame:
    """All silver rows in one frame with ``outcome``, so that one pass can write all tables.

    ``outcome`` is legitimate, fraud or quarantine. Clean rows with a NULL fraud flag belong to no
    table and are left out. Quarantined rows must stay without profile columns: the join has the
    row's state as a second key, which the profile side only has as "clean". Their first key is
    replaced by the impression id, since a missing user id is a common reason for quarantine and
    would otherwise send all those rows to one task.
    """
    flagged = flag_quality(dedup_impressions(bronze)).withColumn(
        "_clean", F.col("quality_issues") == ""
    )
    keyed = flagged.withColumn(
        "_user", F.when(F.col("_clean"), F.col("user_id")).otherwise(F.col("impression_id"))
    )
    known = profiles.select(
        F.col("user_id").alias("_user"), F.lit(True).alias("_clean"), *PROFILE_COLUMNS
    )
    outcome = (
        F.when(~F.col("_clean"), "quarantine")
        .when(F.col("is_fraud"), "fraud")
        .when(~F.col("is_fraud"), "legitimate")
    )
    return (
        keyed.join(known, ["_user", "_clean"], "left")
        .withColumn("outcome", outcome)
        .where(F.col("outcome").isNotNull())
        .select(*SILVER_COLUMNS, "quality_issues", "outcome")
    )
