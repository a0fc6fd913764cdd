"""Keys with the most spend: bounds of summaries, merging, exact leaders."""

import random
from collections import Counter

import pytest

from adlumen.streaming import leaders
from rows import bronze, collect


def spend_of(batches):
    total, seen = Counter(), Counter()
    for rows in batches:
        for key, price in rows:
            if key is not None:
                total[key] += round((price or 0) * 1_000_000) if price and 0 < price < float("inf") else 0
                seen[key] += 1
    return total, seen


def frame(spark, rows):
    return bronze(spark, *[{"advertiser_id": k, "bid_price": p} for k, p in rows])


def random_batches(seed, keys=40, n=4):
    rng = random.Random(seed)
    prices = [0.01, 0.25, 1.5, 3.0, None, -1.0, float("inf"), float("nan")]
    return [[(None if rng.random() < 0.05 else f"adv_{int(rng.paretovariate(1)) % keys:03}", rng.choice(prices)) for _ in range(150)] for _ in range(n)]


def stored(spark, root, batches, size):
    for number, rows in enumerate(batches):
        leaders.store_batch(frame(spark, rows), number, root, "advertiser_id", size)
    return leaders.read_summaries(spark, root)


def exact(batches, n):
    total, seen = spend_of(batches)
    return [(k, round(total[k] / 1e6, 4), seen[k]) for k in sorted(total, key=lambda k: (-total[k], k))[:n]]


def listed(found):
    return [(r.key, r.total_spend, r.impression_count) for r in found.collect()]


@pytest.mark.parametrize("size", [1, 6, 100])
def test_bounds_hold_the_exact_spends_also_when_merged(spark, tmp_path, size):
    root = str(tmp_path / "t")
    batches = random_batches(3)
    summaries = stored(spark, root, batches, size)
    total, _ = spend_of(batches)
    halves = [leaders.merged(summaries.where(f"batch {c}"), size).selectExpr("*", f"{k}L AS batch") for k, c in enumerate(("< 2", ">= 2"))]
    for some in (summaries, halves[0].unionByName(halves[1])):
        known = leaders.bounds(some).collect()
        for r in known:
            assert r.spend <= total[r.key] <= r.spend + r.slack
        rest = sum(r.spend for r in some.where("is_rest").collect())
        assert all(total[k] <= rest for k in set(total) - {r.key for r in known})
    assert leaders.merged(summaries, size).count() <= size + 1


@pytest.mark.parametrize("size", [1, 6, 100])
def test_leaders_are_exact(spark, tmp_path, size):
    root = str(tmp_path / "t")
    batches = random_batches(9)
    stored(spark, root, batches, size)
    summaries = stored(spark, root, batches[:2], size)  # batches sent again change nothing
    for n in (1, 5, 60):
        assert listed(leaders.leaders(spark, root, n)) == exact(batches, n)
    able = leaders.candidates(summaries, 5)
    assert (able is None) == (size < 100)  # small summaries decide nothing here, and all keys are looked up
    assert able is None or able.count() == 5


def test_a_key_that_no_batch_names_can_still_lead(spark, tmp_path):
    batches = [[("steady", 2.0), (f"once_{k}", 3.0)] for k in range(3)]
    stored(spark, str(tmp_path / "t"), batches, 1)
    assert listed(leaders.leaders(spark, str(tmp_path / "t"), 1)) == [("steady", 6.0, 3)]


def test_only_candidates_are_looked_up(spark, tmp_path):
    batches = [[("big", 9.0)] * 5 + [("next", 9.0)] * 3 + [(f"small_{b}_{k}", 0.01) for k in range(20)] for b in range(3)]
    summaries = stored(spark, str(tmp_path / "t"), batches, 4)
    assert collect(leaders.candidates(summaries, 2)) == [("big",), ("next",)]
    assert listed(leaders.leaders(spark, str(tmp_path / "t"), 2)) == [("big", 135.0, 15), ("next", 81.0, 9)]


def test_empty_batches_and_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    stored(spark, root, [[(None, 1.0)]], 3)
    leaders.store_batch(frame(spark, [("a", 1.0)]).limit(0), 1, root, "advertiser_id", 3)
    assert listed(leaders.leaders(spark, root)) == []
    leaders.store_batch(frame(spark, [("a", None), ("b", -2.0)]), 2, root, "advertiser_id", 1)
    assert listed(leaders.leaders(spark, root)) == [("a", 0.0, 1), ("b", 0.0, 1)]


def test_as_a_stream(spark, tmp_path):
    batches = random_batches(4)
    frames = [frame(spark, rows) for rows in batches]
    for one in frames:
        one.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = leaders.start_leaders(stream, str(tmp_path / "t"), str(tmp_path / "checkpoint"), size=8)
    query.awaitTermination()
    assert leaders.read_summaries(spark, str(tmp_path / "t")).select("batch").distinct().count() == 4
    assert listed(leaders.leaders(spark, str(tmp_path / "t"), 7)) == exact(batches, 7)
