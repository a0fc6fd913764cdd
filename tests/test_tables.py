"""Stored tables, runs and streams."""

import datetime as dt
import json
import os

import pytest

from adlumen.operators.gate import GateFailed, assert_gate, assert_null_rates, null_rates, quality_gate
from adlumen.plans import runs
from adlumen.schemas import BRONZE_COLUMNS, QUARANTINE_COLUMNS, SILVER_COLUMNS
from adlumen.sources import tables, topics
from adlumen.sources.tables import Tables
from adlumen.streaming.ingest import start_ingest
from adlumen.streaming.windows import dedup_stream, hourly_revenue_stream, rows_dropped_late
from rows import MESSAGE, T0, bronze, collect, messages, profiles

NEXT_DAY = "2024-03-02T01:00:00Z"
BATCH = [
    {"impression_id": "a"}, {"impression_id": "b", "timestamp": NEXT_DAY}, {"impression_id": "a"},
    {"impression_id": "c", "user_id": "bot_001", "is_fraud": True}, {"bid_price": -1}, "not json",
]


@pytest.fixture
def store(tmp_path):
    return Tables(str(tmp_path / "tables"))


def test_ingest_stores_valid_and_rejected(spark, store):
    counts = runs.run_ingest(messages(spark, *BATCH), store, "one", "feed")
    assert counts == {"valid_count": 4, "invalid_count": 2, "fraud_count": 1}
    stored = tables.read_bronze(spark, store)
    assert stored.columns == BRONZE_COLUMNS
    assert collect(stored, "impression_id", "ingestion_date")[-2:] == [
        ("b", dt.date(2024, 3, 2)), ("c", dt.date(2024, 3, 1))]
    assert sorted(tuple(r.errors) for r in tables.read_rejects(spark, store).collect()) == [
        ("invalid_bid_price",), ("malformed_json",)]
    assert "not json" in [r.value for r in tables.read_rejects(spark, store).collect()]


def test_batch_written_again_replaces_itself(spark, store):
    runs.run_ingest(messages(spark, *BATCH), store, "one", "feed")
    runs.run_ingest(messages(spark, {"impression_id": "z"}), store, "two", "feed")
    runs.run_ingest(messages(spark, *BATCH[:2]), store, "one", "feed")
    assert collect(tables.read_bronze(spark, store), "impression_id") == [("a",), ("b",), ("z",)]
    assert tables.read_rejects(spark, store).count() == 0
    assert tuple(tables.stored_ingest_stats(spark, store).first()) == (3, 0, 0, 0.0)
    with pytest.raises(ValueError):
        runs.run_ingest(messages(spark, {}), store, "../elsewhere", "feed")


def test_empty_batch_adds_nothing(spark, store):
    runs.run_ingest(messages(spark, {}), store, 1, "feed")
    runs.run_ingest(messages(spark, {}).limit(0), store, 2, "feed")
    assert tables.read_ingest(spark, store).count() == 1


def test_dates_prune_partitions(spark, store):
    runs.run_ingest(messages(spark, *BATCH), store, "one", "feed")
    day = dt.date(2024, 3, 2)
    pruned = tables.read_bronze(spark, store, date_from=day, date_to=day)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "ingestion_date" in filters and "outcome" in filters
    assert collect(pruned, "impression_id") == [("b",)]


def test_chain_from_messages_to_gate(spark, store):
    people = profiles(spark, ("user_000001", "premium", True))
    many = [{"impression_id": f"i{n}"} for n in range(20)]
    report = runs.run_chain(spark, store, people, messages(spark, *BATCH, *many, {"impression_id": "q", "country_code": "XX"}), "one", "feed")
    assert report["silver"] == {
        "rows_before": 25, "legitimate": 22, "fraud": 1, "quarantined": 1, "missing_profiles": 1}
    assert report["gold"] == {"revenue_by_advertiser": 2, "content_performance": 2, "fraud_summary": 1}
    assert report["gate"]["passed"] and report["gate"]["fraud_rate"] == 0.04
    assert tables.read_silver(spark, store, "legitimate").columns == SILVER_COLUMNS
    assert tables.read_silver(spark, store, "quarantine").columns == QUARANTINE_COLUMNS
    assert tables.read_gold(spark, store, "fraud_summary").first().top_targeted_advertiser == "adv_001"


def test_runs_over_a_range_leave_other_days_alone(spark, store):
    people = profiles(spark, ("user_000001", "premium", True))
    runs.run_ingest(messages(spark, *BATCH, {"impression_id": "q", "country_code": "XX", "timestamp": NEXT_DAY}), store, "one", "feed")
    runs.run_silver(spark, store, people)
    runs.run_gold(spark, store)
    day = dt.date(2024, 3, 2)
    runs.run_ingest(messages(spark, {"impression_id": "x"}, {"impression_id": "y", "timestamp": NEXT_DAY}), store, "one", "feed")
    assert runs.run_silver(spark, store, people, day, day) == {
        "rows_before": 1, "legitimate": 1, "fraud": 0, "quarantined": 0, "missing_profiles": 0}
    assert collect(tables.read_silver(spark, store, "legitimate"), "impression_id") == [("a",), ("y",)]
    assert collect(tables.read_silver(spark, store, "fraud"), "impression_id") == [("c",)]
    assert tables.read_silver(spark, store, "quarantine").count() == 0
    assert runs.run_gold(spark, store, day, day) == {"revenue_by_advertiser": 1, "content_performance": 1, "fraud_summary": 0}
    assert tables.read_gold(spark, store, "fraud_summary").count() == 1
    assert tables.read_gold(spark, store, "revenue_by_advertiser").count() == 2
    plan = tables.read_silver(spark, store, "legitimate", day, day)._jdf.queryExecution().executedPlan().toString()
    assert "ingestion_date" in plan[plan.index("PartitionFilters"):].split("]")[0]


def test_runs_over_a_range_know_earlier_deliveries(spark, store):
    people = profiles(spark)
    runs.run_ingest(messages(spark, {"impression_id": "a"}, {"impression_id": "a", "timestamp": NEXT_DAY},
                             {"impression_id": "b", "timestamp": NEXT_DAY}), store, "one", "feed")
    runs.run_silver(spark, store, people)
    full = collect(tables.read_silver(spark, store, "legitimate"), "impression_id", "timestamp")
    day = dt.date(2024, 3, 2)
    assert runs.run_silver(spark, store, people, day, day)["legitimate"] == 1
    assert collect(tables.read_silver(spark, store, "legitimate"), "impression_id", "timestamp") == full


def test_silver_rerun_clears_old_quarantine(spark, store):
    people = profiles(spark)
    runs.run_ingest(messages(spark, {"country_code": "XX"}, {"impression_id": "b"}), store, "one", "feed")
    assert runs.run_silver(spark, store, people)["quarantined"] == 1
    runs.run_ingest(messages(spark, {}, {"impression_id": "b"}), store, "one", "feed")
    assert runs.run_silver(spark, store, people)["quarantined"] == 0
    assert tables.read_silver(spark, store, "quarantine").count() == 0
    assert tables.read_silver(spark, store, "legitimate").count() == 2


def test_silver_refuses_duplicate_profiles(spark, store):
    runs.run_ingest(messages(spark, {}), store, "one", "feed")
    with pytest.raises(runs.DuplicateProfiles):
        runs.run_silver(spark, store, profiles(spark, ("u", "free", True), ("u", "basic", True)))


def test_gate(spark):
    good = bronze(spark, *[{}] * 19, {"is_fraud": True})
    assert assert_gate(quality_gate(good, good, good))["fraud_rate"] == 0.05
    tenth = bronze(spark, *[{}] * 9, {"is_fraud": True})
    with pytest.raises(GateFailed, match="fraud_rate_ok"):
        assert_gate(quality_gate(tenth, good, good))
    with pytest.raises(GateFailed, match="silver_not_empty"):
        assert_gate(quality_gate(good, good.limit(0), good))
    empty = quality_gate(good.limit(0), good.limit(0), good.limit(0)).first()
    assert (empty.fraud_rate, empty.fraud_rate_ok, empty.passed) == (0.0, True, False)


def test_null_rates(spark):
    rates = {r.column_name: (r.null_count, r.null_rate, r.within_limit) for r in
             null_rates(bronze(spark, {"user_id": None}, *[{}] * 9)).collect()}
    assert rates["user_id"] == (1, 0.1, False) and rates["bid_price"] == (0, 0.0, True)
    assert_null_rates(null_rates(bronze(spark, {})))
    with pytest.raises(GateFailed, match="user_id"):
        assert_null_rates(null_rates(bronze(spark, {"user_id": None}, {})))


def test_topic_messages_have_the_advertiser_as_key_and_read_back_unchanged(spark):
    rows = bronze(spark, {"timestamp": T0.replace(microsecond=123456), "user_id": None}).drop("ingestion_date")
    message = topics.topic_messages(rows).first()
    assert message.key == "adv_001"
    sent = json.loads(message.value)
    assert sent["timestamp"] == "2024-03-01T12:00:00.123456Z" and sent["user_id"] is None
    again = runs.validate_impressions(topics.topic_messages(rows.fillna({"user_id": "u"})))
    assert collect(again, "timestamp", "bid_price") == [(T0.replace(microsecond=123456), 0.45)]


# --- streams ------------------------------------------------------------------------------


def put(folder, name, *values):
    os.makedirs(folder, exist_ok=True)
    lines = [v if isinstance(v, str) else json.dumps({**MESSAGE, **v}) for v in values]
    with open(os.path.join(folder, f".{name}"), "w") as out:
        out.write("\n".join(lines) + "\n")
    os.replace(os.path.join(folder, f".{name}"), os.path.join(folder, name))


def ingest(spark, tmp_path, store):
    source = topics.file_messages(spark, str(tmp_path / "in"), max_files_per_batch=1)
    query = start_ingest(source, store, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    return query


def test_stream_resumes_without_loss_or_repetition(spark, tmp_path, store):
    put(tmp_path / "in", "1.txt", {"impression_id": "a"}, "not json")
    put(tmp_path / "in", "2.txt", {"impression_id": "b"})
    ingest(spark, tmp_path, store)
    put(tmp_path / "in", "3.txt", {"impression_id": "c"})
    ingest(spark, tmp_path, store)
    ingest(spark, tmp_path, store)
    assert collect(tables.read_ingest(spark, store), "batch_id", "impression_id", "outcome") == [
        ("0", "a", "valid"), ("0", None, "rejected"), ("1", "b", "valid"), ("2", "c", "valid")]


def test_sources_do_not_replace_each_other(spark, tmp_path, store):
    put(tmp_path / "in", "1.txt", {"impression_id": "a"})
    put(tmp_path / "in", "2.json", {"impression_id": "b"})
    put(tmp_path / "in", "3.jsonl", {"impression_id": "c"})
    ingest(spark, tmp_path, store)
    put(tmp_path / "other", "1.txt", {"impression_id": "d"})
    for checkpoint in ("second", "third"):  # another stream, and the same one from its beginning
        start_ingest(topics.file_messages(spark, str(tmp_path / "other")), store, str(tmp_path / checkpoint)).awaitTermination()
    runs.run_ingest(messages(spark, {"impression_id": "e"}), store, 0, "feed")
    runs.run_ingest(messages(spark, {"impression_id": "f"}), store, 0, source="elsewhere")
    assert collect(tables.read_bronze(spark, store), "impression_id") == [(x,) for x in "abcddef"]


def test_frames_of_a_topic_keep_their_position(spark, store):
    value = json.dumps({**MESSAGE, "impression_id": "a"}).encode()
    frame = spark.createDataFrame(
        [(b"k", value, "ads", 3, 17, T0, 0), (None, b"no json", "ads", 3, 18, T0, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    runs.run_ingest(frame, store, "one", "feed")
    assert collect(tables.read_ingest(spark, store), "position", "impression_id", "outcome") == [
        ("ads/3/17", "a", "valid"), ("ads/3/18", None, "rejected")]
    assert runs.validate_impressions(frame).columns[:2] == ["value", "source"]


def test_batch_that_was_written_but_not_recorded_is_replaced(spark, tmp_path, store):
    put(tmp_path / "in", "1.txt", {"impression_id": "a"}, {"impression_id": "b"}, {"impression_id": "x", "bid_price": 0})
    ingest(spark, tmp_path, store)
    commits = tmp_path / "checkpoint" / "commits"
    (commits / "0").unlink()
    (commits / ".0.crc").unlink()
    ingest(spark, tmp_path, store)
    assert collect(tables.read_ingest(spark, store), "impression_id", "outcome") == [
        ("a", "valid"), ("b", "valid"), (None, "rejected")]


def test_stream_and_batch_agree(spark, tmp_path, store):
    put(tmp_path / "in", "1.txt", *BATCH[:3])
    put(tmp_path / "in", "2.txt", *BATCH[3:])
    ingest(spark, tmp_path, store)
    batch = Tables(str(tmp_path / "batch"))
    runs.run_ingest(messages(spark, *BATCH), batch, 0, "feed")
    assert collect(tables.read_bronze(spark, store)) == collect(tables.read_bronze(spark, batch))


def impressions_stream(spark, tmp_path, *batches):
    folder = str(tmp_path / "impressions")
    for rows in batches:
        bronze(spark, *rows).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(stream, tmp_path, name):
    (stream.writeStream.format("parquet").option("path", str(tmp_path / name))
     .option("checkpointLocation", str(tmp_path / f"{name}-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_repeated_deliveries_across_batches_are_dropped(spark, tmp_path):
    soon = T0 + dt.timedelta(minutes=5)
    stream = impressions_stream(
        spark, tmp_path, [{"impression_id": "a"}, {"impression_id": "b"}],
        [{"impression_id": "a", "timestamp": soon}, {"impression_id": "c", "timestamp": soon}])
    assert collect(drain(dedup_stream(stream), tmp_path, "out"), "impression_id") == [("a",), ("b",), ("c",)]


def test_late_rows_are_counted(spark, tmp_path):
    def at(hours, name):
        return {"timestamp": T0 + dt.timedelta(hours=hours), "impression_id": name}

    stream = dedup_stream(impressions_stream(spark, tmp_path, [at(0, "a"), at(6, "b")], [at(5.5, "c")], [at(1, "late")], [at(6, "b"), at(7, "d")]))
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert collect(spark.read.schema(stream.schema).parquet(str(tmp_path / "out")), "impression_id") == [(x,) for x in "abcd"]
    assert rows_dropped_late(query) == 1


def test_streamed_hours_equal_the_table(spark, tmp_path):
    from adlumen.operators import gold
    from adlumen.operators.silver import enrich

    def at(minutes, **change):
        return {"timestamp": T0 + dt.timedelta(minutes=minutes), "impression_id": f"m{minutes}", **change}

    first = [at(1), at(2, campaign_id="c2"), at(3, advertiser_id="b", bid_price=2.0), at(4, country_code="XX")]
    second = [at(2, campaign_id="c2"), at(50, is_fraud=True), at(59, bid_price=0.1)]
    third = [at(61), at(300)]
    hours = drain(hourly_revenue_stream(impressions_stream(spark, tmp_path, first, second, third)), tmp_path, "out")
    rows = enrich(bronze(spark, first[0], first[1], first[2], second[2], third[0]), profiles(spark))
    table = gold.revenue_by_advertiser(rows).select(*hours.columns)
    assert hours.count() == 3 and collect(hours) == collect(table)
