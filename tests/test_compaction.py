"""Compacted days: the same rows at every moment, in files that follow the rows."""

import datetime as dt
import os

import pytest

from adlumen.plans import runs
from adlumen.sources import compaction, tables
from adlumen.sources.tables import Tables, compact_ingest
from rows import collect, messages, profiles

DAY = [dt.date(2024, 3, n) for n in range(1, 6)]


@pytest.fixture
def store(tmp_path):
    return Tables(str(tmp_path / "tables"))


def sent(name, day, **change):
    return {"impression_id": name, "timestamp": f"{DAY[day]}T10:00:00Z", **change}


def ingest(spark, store, batch, *rows, source="feed"):
    runs.run_ingest(messages(spark, *rows), store, batch, source)


def plain(spark, store):
    """All rows from the batches, whatever was compacted."""
    return tables.read_table(spark, store.ingest, "parquet", tables.INGEST_SCHEMA)


def same_rows(spark, store):
    names = [c for c in tables.INGEST_SCHEMA.fieldNames() if c != "errors"]
    assert collect(tables.read_ingest(spark, store), *names) == collect(plain(spark, store), *names)


def files_of(frame):
    return [f for f in frame.inputFiles()]


def test_files_of_a_day_do_not_follow_the_batches(spark, store):
    for n in range(7):
        ingest(spark, store, n, *[sent(f"i{n}-{m}", m % 3, advertiser_id=f"adv_{m:03d}") for m in range(12)])
    before = tables.read_bronze(spark, store, days=[DAY[1]])
    assert len(files_of(before)) >= 7
    assert compact_ingest(spark, store, until=DAY[2]) == DAY[:2]
    same_rows(spark, store)
    day = tables.read_bronze(spark, store, days=[DAY[1]]).where("advertiser_id = 'adv_004'")
    assert len(files_of(day)) == 1 and "/compacted/" in files_of(day)[0]
    assert day.count() == 7
    # The open day comes from its batches, and only it does.
    both = files_of(tables.read_bronze(spark, store, DAY[1], DAY[2]))
    assert {"ingestion_date=2024-03-03" in f for f in both if "/compacted/" not in f} == {True}


def test_a_hot_advertiser_is_split_and_files_are_ordered(spark, store):
    for n in range(3):
        ingest(spark, store, n, *[sent(f"i{n}-{m}", 0, advertiser_id="adv_001" if m % 3 else f"adv_{m + 2:03d}") for m in range(40)])
    compact_ingest(spark, store, days=[DAY[0]], rows_per_file=20)
    files = files_of(tables.read_bronze(spark, store))
    assert 5 <= len(files) <= 9  # 120 rows
    spans = []
    for file in files:
        ids = [r[0] for r in spark.read.parquet(file).select("advertiser_id").collect()]
        assert ids == sorted(ids) and len(ids) <= 60
        spans.append((ids[0], ids[-1]))
    spans.sort()
    assert all(left[1] <= right[0] for left, right in zip(spans, spans[1:]))
    assert sum(low <= "adv_001" <= high for low, high in spans) > 1
    same_rows(spark, store)


def test_changed_days_are_read_from_batches_until_the_next_run(spark, store):
    ingest(spark, store, "a", sent("x", 0), sent("y", 1), "not json", sent("r", 0, bid_price=-1))
    ingest(spark, store, "b", sent("z", 1))
    today = plain(spark, store).where("value = 'not json'").first().ingestion_date
    assert compact_ingest(spark, store, until=today + dt.timedelta(days=1)) == [*DAY[:2], today]
    same_rows(spark, store)
    assert compact_ingest(spark, store, until=DAY[4]) == []
    ingest(spark, store, "b", sent("z2", 1), sent("late", 2))  # replaced, and a new day
    same_rows(spark, store)
    assert collect(tables.read_bronze(spark, store, days=[DAY[1]]), "impression_id") == [("y",), ("z2",)]
    ingest(spark, store, "a", sent("x", 0), source="other")  # the same batch id of another feed
    same_rows(spark, store)
    assert compact_ingest(spark, store, until=DAY[4]) == DAY[:3]
    same_rows(spark, store)
    assert all("/compacted/" in f for f in files_of(tables.read_bronze(spark, store)))
    assert tables.read_rejects(spark, store).count() == 2


def test_a_batch_emptied_again_returns_a_day_to_its_first_layout(spark, store):
    ingest(spark, store, "a", sent("x", 0))
    compact_ingest(spark, store, until=DAY[4])
    ingest(spark, store, "b", sent("y", 0))
    compact_ingest(spark, store, until=DAY[4])
    assert compaction.layouts(spark, store).count() == 2
    runs.run_ingest(messages(spark, {}).limit(0), store, "b", "feed")
    same_rows(spark, store)
    assert compact_ingest(spark, store, until=DAY[4]) == []
    counts = tables.read_counts(spark, store)
    assert compaction.remove_superseded(spark, store, counts) == 1
    assert compaction.remove_superseded(spark, store, counts) == 0
    same_rows(spark, store)
    assert files_of(tables.read_bronze(spark, store))[0].count("/compacted/") == 1
    # A removed layout is not taken again when its state comes back.
    ingest(spark, store, "b", sent("y", 0))
    same_rows(spark, store)


def test_a_run_that_fails_before_its_log_changes_nothing(spark, store, monkeypatch):
    ingest(spark, store, "a", sent("x", 0), sent("y", 1))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_log", broken)
        with pytest.raises(OSError):
            compact_ingest(spark, store, until=DAY[4])
    assert os.path.isdir(store.compacted)
    same_rows(spark, store)
    assert compact_ingest(spark, store, until=DAY[4]) == DAY[:2]
    same_rows(spark, store)


def test_a_write_during_a_run_leaves_the_day_to_its_batches(spark, store, monkeypatch):
    ingest(spark, store, "a", sent("x", 0))
    log = compaction._log

    def meanwhile(*args):
        ingest(spark, store, "a", sent("x2", 0), sent("x3", 0))
        log(*args)

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_log", meanwhile)
        assert compact_ingest(spark, store, until=DAY[4]) == DAY[:1]
    assert all("/compacted/" not in f for f in files_of(tables.read_bronze(spark, store)))
    same_rows(spark, store)
    assert compact_ingest(spark, store, until=DAY[4]) == DAY[:1]
    same_rows(spark, store)


def test_runs_take_compacted_days(spark, store, tmp_path):
    rows = [[sent("a", 0), sent("b", 1), sent("q", 1, country_code="XX")], [sent("a", 1), sent("c", 0, is_fraud=True, user_id="bot_001")]]
    people = profiles(spark, ("user_000001", "premium", True))
    other = Tables(str(tmp_path / "other"))
    results = []
    for place in (store, other):
        for n, batch in enumerate(rows):
            ingest(spark, place, n, *batch)
        if place is store:
            compact_ingest(spark, place, until=DAY[1])
        counts = runs.run_silver(spark, place, people)
        results.append((counts, runs.run_gold(spark, place), collect(tables.read_gold(spark, place, "revenue_by_advertiser"))))
    assert results[0] == results[1]


def test_odd_calls(spark, store):
    ingest(spark, store, "a", sent("x", 0))
    with pytest.raises(ValueError, match="days"):
        compact_ingest(spark, store)
    with pytest.raises(ValueError, match="Parquet"):
        compact_ingest(spark, Tables(store.root, "delta"), until=DAY[4])
    assert compact_ingest(spark, store, days=[DAY[3]]) == []
    assert compact_ingest(spark, store, until=DAY[0]) == []
    compact_ingest(spark, store, until=DAY[4])
    assert tables.read_bronze(spark, store, days=[DAY[3]]).count() == 0
    assert tables.read_bronze(spark, store, days=[]).count() == 0
