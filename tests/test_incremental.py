"""Stored totals, the id index, and runs over what has changed."""

import datetime as dt

import pytest

from adlumen.plans import runs
from adlumen.plans.incremental import changes, run_incremental
from adlumen.sources import tables
from adlumen.sources.ids import first_deliveries, later_days, read_ids, write_ids
from adlumen.sources.tables import Tables
from rows import bronze, collect, messages, profiles

DAYS = [f"2024-03-0{n}T10:00:00Z" for n in range(1, 7)]


def sent(name, day, **change):
    return {"impression_id": name, "timestamp": DAYS[day], **change}


@pytest.fixture
def store(tmp_path):
    return Tables(str(tmp_path / "tables"), id_buckets=4)


@pytest.fixture
def people(spark):
    return profiles(spark, ("user_000001", "premium", True))


def everything(spark, store):
    out = {}
    for name in ("legitimate", "fraud", "quarantine"):
        out[name] = collect(tables.read_silver(spark, store, name))
    for name in tables.GOLD_COLUMNS:
        out[name] = collect(tables.read_gold(spark, store, name))
    return out


def equals_full_run(spark, store, people, tmp_path, *batches):
    full = Tables(str(tmp_path / "full"), id_buckets=4)
    for number, batch in enumerate(batches):
        runs.run_ingest(messages(spark, *batch), full, number, "feed")
    runs.run_silver(spark, full, people)
    runs.run_gold(spark, full)
    assert everything(spark, store) == everything(spark, full)


FIRST = [sent("a", 0), sent("b", 2), sent("c", 3, is_fraud=True, user_id="bot_001"), sent("d", 4, country_code="XX"), sent("e", 5)]


def test_late_rows_change_their_days_and_those_of_later_copies(spark, store, people, tmp_path):
    runs.run_ingest(messages(spark, *FIRST), store, 0, "feed")
    assert len(run_incremental(spark, store, people)["days"]) == 5
    assert run_incremental(spark, store, people) == {"days": []}
    # A new row, the first delivery of what day 3 and 4 have counted already, and a later copy.
    late = [sent("f", 1), sent("b", 1), sent("d", 1), sent("a", 1)]
    runs.run_ingest(messages(spark, *late), store, 1, "feed")
    report = run_incremental(spark, store, people)
    assert report["days"] == [dt.date(2024, 3, 2), dt.date(2024, 3, 3), dt.date(2024, 3, 5)]
    assert collect(tables.read_silver(spark, store, "legitimate"), "impression_id", "ingestion_date") == [
        ("a", dt.date(2024, 3, 1)), ("b", dt.date(2024, 3, 2)), ("d", dt.date(2024, 3, 2)), ("e", dt.date(2024, 3, 6)), ("f", dt.date(2024, 3, 2))]
    equals_full_run(spark, store, people, tmp_path, FIRST, late)


def test_a_batch_sent_again_with_fewer_rows(spark, store, people, tmp_path):
    early = [sent("e", 0), sent("g", 1)]
    runs.run_ingest(messages(spark, *early), store, 0, "feed")
    runs.run_ingest(messages(spark, *FIRST), store, 1, "feed")
    run_incremental(spark, store, people)
    assert ("e", dt.date(2024, 3, 1)) in collect(tables.read_silver(spark, store, "legitimate"), "impression_id", "ingestion_date")
    runs.run_ingest(messages(spark, sent("g", 1)), store, 0, "feed")  # its first day is gone, and e's first delivery
    assert dt.date(2024, 3, 6) in run_incremental(spark, store, people)["days"]
    assert ("e", dt.date(2024, 3, 6)) in collect(tables.read_silver(spark, store, "legitimate"), "impression_id", "ingestion_date")
    equals_full_run(spark, store, people, tmp_path, [sent("g", 1)], FIRST)


def test_a_run_that_failed_is_repeated(spark, store, people, tmp_path):
    runs.run_ingest(messages(spark, *FIRST), store, 0, "feed")
    with pytest.raises(runs.DuplicateProfiles):
        run_incremental(spark, store, people.union(people))
    assert changes(spark, store).count() == 5
    run_incremental(spark, store, people)
    assert changes(spark, store).count() == 0
    equals_full_run(spark, store, people, tmp_path, FIRST)


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_the_index_is_joined_as_it_lies_and_only_named_days_are_read(spark, store):
    rows = bronze(spark, *[{"impression_id": f"i{n}", "timestamp": dt.datetime(2024, 3, 1 + n % 4, 9)} for n in range(40)])
    days = [dt.date(2024, 3, n) for n in range(1, 5)]
    write_ids(rows, store, days)
    index = read_ids(spark, store)
    assert collect(index) == collect(rows, "impression_id", "ingestion_date")
    new = bronze(spark, {"impression_id": "i0", "timestamp": dt.datetime(2024, 3, 6)}, {"impression_id": "x", "timestamp": dt.datetime(2024, 3, 6)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(first_deliveries(new, index.where("ingestion_date < DATE '2024-03-03'")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert collect(first_deliveries(new, index), "impression_id") == [("x",)]
    scan = plan[plan.index("FileScan parquet"):]
    assert "Bucketed: true" in scan and "ingestion_date" in scan[scan.index("PartitionFilters"):].split("]")[0]
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1  # the new rows; never the index
    assert later_days(bronze(spark, {"impression_id": "i3", "timestamp": dt.datetime(2024, 3, 1)}), index) == [dt.date(2024, 3, 4)]
    write_ids(rows.where("ingestion_date = DATE '2024-03-01'"), store, days[:2])
    assert {r[0] for r in read_ids(spark, store).select("ingestion_date").collect()} == {days[0], days[2], days[3]}


def test_a_missing_id_is_one_id(spark, store):
    row = bronze(spark, {"impression_id": None, "timestamp": dt.datetime(2024, 3, 1)})
    write_ids(row, store, [dt.date(2024, 3, 1)])
    again = bronze(spark, {"impression_id": None, "timestamp": dt.datetime(2024, 3, 2)})
    assert first_deliveries(again, read_ids(spark, store)).count() == 0
    assert first_deliveries(row, read_ids(spark, store)).count() == 1


def test_totals_come_from_the_counts_alone(spark, store, tmp_path):
    runs.run_ingest(messages(spark, *FIRST, "not json"), store, "one", "web")
    runs.run_ingest(messages(spark, sent("x", 1)), store, "one", "app")  # the same batch id from another feed
    assert tuple(tables.stored_ingest_stats(spark, store).first()) == (6, 1, 1, 0.1667)
    assert tables.read_bronze(spark, store).count() == 6
    for _ in range(2):
        runs.run_ingest(messages(spark, sent("x", 1), {"bid_price": -1}), store, "one", "app")
    assert tuple(tables.stored_ingest_stats(spark, store).first()) == (6, 2, 1, 0.1667)
    runs.run_ingest(messages(spark, {}).limit(0), store, "one", "app")
    assert tuple(tables.stored_ingest_stats(spark, store).first()) == (5, 1, 1, 0.2)
    assert all("/ingest/counts/" in f for f in tables.stored_ingest_stats(spark, store).inputFiles())


def test_a_chain_over_a_range_needs_a_source(spark, store, people):
    with pytest.raises(ValueError, match="source"):
        runs.run_chain(spark, store, people, messages(spark, *FIRST), "one")
    many = [sent(f"m{n}", 2) for n in range(20)]
    day = dt.date(2024, 3, 3)
    report = runs.run_chain(spark, store, people, messages(spark, *FIRST, *many), "one", "feed", day, day)
    assert report["silver"]["rows_before"] == 21 and report["gate"]["passed"] and report["gate"]["bronze_rows"] == 21
    assert {r[0] for r in tables.read_gold(spark, store, "revenue_by_advertiser").select("ingestion_date").collect()} == {day}
