import datetime as dt

import pytest

from adlumen.operators import silver
from rows import T0, bronze, collect, profiles

LATER = T0 + dt.timedelta(seconds=1)


def flags(spark, *changes):
    flagged = silver.flag_quality(bronze(spark, *changes)).orderBy("impression_id")
    return [r.quality_issues for r in flagged.collect()]


def test_every_flag(spark):
    assert flags(
        spark, {}, {"bid_price": None}, {"user_id": None}, {"country_code": "XX"}, {"currency": "JPY"},
        {"bid_price": 50.01}, {"bid_price": 50.0}, {"bid_price": float("nan")},
    ) == ["", "null_bid_price", "null_user_id", "invalid_country", "invalid_currency",
          "bid_price_exceeds_threshold", "", "bid_price_exceeds_threshold"]


def test_flags_are_listed_in_order(spark):
    assert flags(spark, {"user_id": None, "country_code": "XX", "bid_price": 99.0}) == [
        "null_user_id, invalid_country, bid_price_exceeds_threshold"]


def test_null_country_and_currency_are_clean_and_silver_knows_nine_currencies(spark):
    assert flags(spark, {"country_code": None}, {"currency": None}, {"currency": "CAD"}) == ["", "", ""]


def test_earliest_copy_survives_and_null_is_one_key(spark):
    rows = bronze(spark, {"impression_id": "a", "timestamp": LATER}, {"impression_id": "a"},
                  {"impression_id": None}, {"impression_id": None, "timestamp": LATER}, {"impression_id": "b"})
    assert collect(silver.dedup_impressions(rows), "impression_id", "timestamp") == [
        ("a", T0), ("b", T0), (None, T0)]
    assert tuple(silver.dedup_stats(rows).first()) == (5, 3, 2)


def test_equal_times_are_settled_by_the_other_columns(spark):
    rows = bronze(spark, *[{"impression_id": "a", "bid_price": p} for p in (3.0, 1.0, 2.0)])
    for parts in (1, 3):
        assert collect(silver.dedup_impressions(rows.repartition(parts)), "bid_price") == [(1.0,)]


def test_dedup_comes_before_the_quality_check(spark):
    rows = bronze(spark, {"impression_id": "a", "user_id": None},
                  {"impression_id": "a", "timestamp": LATER})
    tables = silver.silver(rows, profiles(spark, ("user_000001", "free", True)))
    assert (tables.legitimate.count(), tables.quarantine.count()) == (0, 1)


def test_hot_id_is_reduced_before_the_shuffle(spark):
    plan = silver.dedup_impressions(bronze(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_enrich_keeps_impressions_without_profile(spark):
    rows = bronze(spark, {"user_id": "u1"}, {"user_id": "bot_001", "is_fraud": True})
    people = profiles(spark, ("u1", "premium", True))
    enriched = silver.enrich(rows, people)
    assert enriched.columns[0] == "user_id" and "created_at" not in enriched.columns
    assert collect(enriched, "user_id", "account_tier") == [("bot_001", None), ("u1", "premium")]
    assert tuple(silver.enrich_stats(enriched).first()) == (2, 1)
    assert collect(silver.missing_profiles(rows, people), "user_id") == [("bot_001",)]


def test_profile_join_broadcasts_only_below_the_size_limit(spark, tmp_path):
    profiles(spark, ("u1", "free", True)).write.parquet(str(tmp_path / "profiles"))
    rows, people = bronze(spark, {}), spark.read.parquet(str(tmp_path / "profiles"))

    def plan():
        return silver.enrich(rows, people)._jdf.queryExecution().executedPlan().toString()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        assert "BroadcastHashJoin" in plan()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_null_fraud_flag_is_on_neither_side_but_counted(spark):
    rows = silver.enrich(bronze(spark, {}, {"is_fraud": True}, {"is_fraud": None}), profiles(spark))
    assert silver.legitimate_rows(rows).count() == silver.fraud_rows(rows).count() == 1
    assert tuple(silver.split_stats(rows).first()) == (1, 1, 1, 0.3333)
    assert silver.split_stats(rows.limit(0)).first().fraud_rate == 0.0


def test_single_pass_outcomes_equal_the_three_tables(spark):
    rows = bronze(
        spark, {"user_id": "u1"}, {"user_id": "u2", "is_fraud": True}, {"user_id": None},
        {"user_id": "u1", "country_code": "XX"}, {"user_id": "u1", "is_fraud": None},
        {"impression_id": "u1", "user_id": None}, {"user_id": "u9", "currency": None})
    people = profiles(spark, ("u1", "premium", True), ("u2", "free", False))
    tables = silver.silver(rows, people)
    outcomes = silver.silver_outcomes(rows, people)
    for name, table in tables._asdict().items():
        got = outcomes.where(f"outcome = '{name}'").select(*table.columns)
        assert collect(got) == collect(table), name
    assert outcomes.count() == 6  # all but the clean row without a flag


def test_sample_is_ordered(spark):
    flagged = silver.flag_quality(bronze(spark, *[{"impression_id": f"i{n}", "user_id": None} for n in (4, 2, 3, 1)]))
    assert [r.impression_id for r in silver.quarantine_sample(flagged).collect()] == ["i1", "i2", "i3"]


def test_duplicate_profiles_are_found(spark):
    people = profiles(spark, ("u1", "free", True), ("u1", "basic", True), ("u2", "free", True))
    assert collect(silver.duplicate_profiles(people)) == [("u1", 2)]


@pytest.mark.parametrize("name", ["clean", "quarantined"])
def test_quality_stats(spark, name):
    stats = silver.quality_stats(silver.flag_quality(bronze(spark, {}, {}, {"user_id": None})))
    assert stats.first()[name] == {"clean": 2, "quarantined": 1}[name]
