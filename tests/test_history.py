"""Changing profiles, bursts of fraud, drift of prices, mergeable distinct counts."""

import datetime as dt

import pytest

from adlumen.operators import bursts
from adlumen.operators.gate import GateFailed, assert_price_drift
from adlumen.operators.history import apply_profile_changes, enrich_as_of
from rows import T0, bronze, collect

H = dt.timedelta(hours=1)
FEED = "user_id STRING, op STRING, changed_at TIMESTAMP, seq INT, account_tier STRING, registration_country STRING, preferred_currency STRING, is_verified BOOLEAN"


def feed(spark, *rows):
    return spark.createDataFrame([(u, op, T0 + h * H, seq, tier, "US", "USD", True) for u, op, h, seq, tier in rows], FEED)


def test_changes_become_ranges(spark):
    changes = feed(spark, ("u", "update", 5, 2, "basic"), ("u", "insert", 0, 1, "free"), ("u", "update", 5, 3, "premium"), ("u", "update", 5, 3, "premium"),
                   ("u", "delete", 8, 4, None), ("u", "insert", 10, 5, "basic"), ("w", "delete", 0, 1, None), (None, "insert", 0, 1, "free"))
    assert collect(apply_profile_changes(changes), "user_id", "account_tier", "valid_from", "valid_to") == [
        ("u", "basic", T0 + 10 * H, None), ("u", "free", T0, T0 + 5 * H), ("u", "premium", T0 + 5 * H, T0 + 8 * H)]


def test_impressions_get_the_profile_of_their_time(spark):
    ranges = apply_profile_changes(feed(spark, ("u", "insert", 0, 1, "free"), ("u", "update", 2.5, 2, "premium"), ("u", "update", 2.75, 3, "enterprise"),
                                        ("u", "delete", 30, 4, None), ("u", "insert", 40, 5, "basic"), ("v", "insert", 1, 1, "basic")))
    def seen(name, user, h):
        return {"impression_id": name, "user_id": user, "timestamp": T0 + h * H}

    rows = bronze(spark, seen("a", "u", -1), seen("b", "u", 0), seen("c", "u", 2.4), seen("d", "u", 2.5), seen("e", "u", 2.9), seen("f", "u", 29.99), seen("g", "u", 30),
                  seen("h", "u", 39), seen("i", "u", 40.5), seen("j", "v", 0.9), seen("k", "v", 500), seen("l", None, 3), seen("m", "stranger", 3), seen("n", "u", 20))
    got = enrich_as_of(rows, ranges)
    assert collect(got, "impression_id", "account_tier") == [
        ("a", None), ("b", "free"), ("c", "free"), ("d", "premium"), ("e", "enterprise"), ("f", "enterprise"), ("g", None), ("h", None), ("i", "basic"), ("j", None),
        ("k", "basic"), ("l", None), ("m", None), ("n", "enterprise")]
    assert enrich_as_of(rows, ranges.limit(0)).where("account_tier is null").count() == 14
    assert enrich_as_of(rows.limit(0), ranges).count() == 0


def at(minutes, user="bot_001", **change):
    return {"user_id": user, "timestamp": T0 + dt.timedelta(minutes=minutes), "is_fraud": True, **change}


BURSTS = [at(0), at(30), at(59), at(89.1), at(89.1), at(300, bid_price=1.0), at(10, "bot_002"), at(45, "bot_002"), at(3, None)]


def test_bursts_end_with_a_gap(spark):
    got = collect(bursts.fraud_sessions(bronze(spark, *BURSTS)), "user_id", "started", "ended", "impressions", "revenue_at_risk")
    minute = dt.timedelta(minutes=1)
    assert got == [("bot_001", T0, T0 + 59 * minute, 3, 1.35), ("bot_001", T0 + 89.1 * minute, T0 + 89.1 * minute, 2, 0.9), ("bot_001", T0 + 300 * minute, T0 + 300 * minute, 1, 1.0),
                   ("bot_002", T0 + 10 * minute, T0 + 10 * minute, 1, 0.45), ("bot_002", T0 + 45 * minute, T0 + 45 * minute, 1, 0.45)]


def test_streamed_bursts_equal_the_batch(spark, tmp_path):
    for part in (BURSTS[:2] + BURSTS[6:], BURSTS[2:6], [at(5000, "end")]):
        bronze(spark, *part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(bronze(spark, {}).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream = bursts.fraud_sessions_stream(source.withWatermark("timestamp", "1 hour"))
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert collect(got) == collect(bursts.fraud_sessions(bronze(spark, *BURSTS)).select(got.columns))


def test_a_shift_of_prices_fails_the_gate(spark):
    def day(n, factor):
        return [{"bid_price": factor * (1 + k % 40) / 10, "timestamp": T0 + dt.timedelta(days=n, seconds=k)} for k in range(200)]

    odd = [{"bid_price": p, "timestamp": T0} for p in (None, 0.0, -1.0, float("inf"), float("nan"))]
    quiet = bursts.bid_price_drift(bursts.price_bins(bronze(spark, *day(0, 1), *day(1, 1), *odd)))
    assert_price_drift(quiet)
    rows = {r.ingestion_date.day: r for r in quiet.collect()}
    assert rows[1].prices == 200 and rows[1].distance is None and rows[2].distance == 0.0
    assert abs(rows[1].median_price / 2.0 - 1) <= 0.01 and abs(rows[1].p95_price / 3.8 - 1) <= 0.01
    with pytest.raises(GateFailed, match="2024-03-03"):
        assert_price_drift(bursts.bid_price_drift(bursts.price_bins(bronze(spark, *day(0, 1), *day(1, 1), *day(2, 1.5)))))


def test_sketches_of_days_are_united(spark):
    rows = bronze(spark, *[{"user_id": f"u{k % 900}", "timestamp": T0 + dt.timedelta(days=k % 3)} for k in range(3000)])
    sketches = bursts.distinct_sketches(rows)
    assert sketches.count() == 3
    row = bursts.distinct_over_range(sketches).first()
    assert abs(row.user_id_count - 900) <= 18 and row.advertiser_id_count == 1 and row.standard_error == 0.0065
    assert bursts.distinct_over_range(sketches.limit(0)).first().user_id_count == 0
