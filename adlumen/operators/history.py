"""Profiles as they change: ordered application of a change feed, and the profile valid at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlumen.schemas import PROFILE_COLUMNS


def apply_profile_changes(changes: DataFrame) -> DataFrame:
    """Validity ranges from a feed of (user_id, op, changed_at, seq, profile columns).

    ``op`` is insert, update or delete; insert and update both set the whole profile. Changes of a
    user apply in the order of their time, then of ``seq``; of those at one time the last one counts,
    and a change delivered again counts once. Returns the profile columns with valid_from and
    valid_to (exclusive, NULL while valid); after a delete there is no range until the next change.
    """
    last = F.max_by(F.struct("op", *PROFILE_COLUMNS), "seq").alias("change")
    at_once = changes.where(F.col("user_id").isNotNull()).groupBy("user_id", "changed_at").agg(last)
    following = Window.partitionBy("user_id").orderBy("changed_at")
    ranges = at_once.withColumn("valid_to", F.lead("changed_at").over(following))
    return ranges.where("change.op <> 'delete'").select(
        "user_id", *[F.col(f"change.{c}").alias(c) for c in PROFILE_COLUMNS],
        F.col("changed_at").alias("valid_from"), "valid_to",
    )


def enrich_as_of(impressions: DataFrame, ranges: DataFrame) -> DataFrame:
    """Impressions with the profile that was valid at their time; without one they keep NULLs.

    Nothing is paired: for each user and hour with impressions there is one row with all states of
    that hour in order, the one it begins with included, and an impression picks its own from it.
    The window that carries states along sees a user's changes and hours, never the impressions, and
    the join is an ordinary one, which adaptive execution can split for a user with very many.
    """
    state = F.struct(*PROFILE_COLUMNS)
    starts = ranges.select("user_id", F.col("valid_from").alias("at"), F.lit(0).alias("mark"), F.struct(F.lit(True).alias("known"), state.alias("profile")).alias("state"))
    nobody = F.struct(F.lit(False).alias("known"), F.lit(None).cast(ranges.select(state.alias("s")).schema["s"].dataType).alias("profile"))
    ended = ranges.where("valid_to is not null").select("user_id", F.col("valid_to").alias("at"), F.lit(0).alias("mark"), nobody.alias("state"))
    # An end and a start at the same time: the start counts.
    changes = starts.unionByName(ended).groupBy("user_id", "at", "mark").agg(F.max_by("state", "state.known").alias("state"))
    hour = F.date_trunc("hour", "timestamp")
    hours = impressions.where(F.col("user_id").isNotNull()).select("user_id", hour.alias("at")).distinct()
    marks = hours.select("user_id", "at", F.lit(1).alias("mark"), F.lit(None).cast(changes.schema["state"].dataType).alias("state"))
    so_far = Window.partitionBy("user_id").orderBy("at", "mark").rowsBetween(Window.unboundedPreceding, 0)
    carried = changes.unionByName(marks).withColumn("state", F.last("state", ignorenulls=True).over(so_far))
    states = (
        carried.groupBy("user_id", F.date_trunc("hour", "at").alias("_hour"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "mark", "state"))).alias("_states"))
    )
    joined = impressions.withColumn("_hour", hour).join(states, ["user_id", "_hour"], "left")
    before = F.filter("_states", lambda s: s["at"] <= F.col("timestamp"))
    profile = F.try_element_at(before, F.lit(-1))["state"]["profile"]
    return joined.withColumn("_profile", profile).select(
        *impressions.columns, *[F.col("_profile")[c].alias(c) for c in PROFILE_COLUMNS])
