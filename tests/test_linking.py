import datetime as dt
import random

from adlumen.operators.linking import engagement_by_content, payment_reconciliation
from adlumen.schemas import ENGAGEMENT_SCHEMA, PAYMENT_SCHEMA
from rows import T0, bronze, collect

H = dt.timedelta(hours=1)
MICRO = dt.timedelta(microseconds=1)


def payments(spark, *rows):
    return spark.createDataFrame(
        [(f"p{i}", adv, camp, 100.0, "USD", "batch", "settled", ts) for i, (adv, camp, ts) in enumerate(rows)],
        PAYMENT_SCHEMA)


def matched(frame):
    return [(n, s) for _, n, s in collect(frame, "payment_id", "matched_impressions", "matched_spend")]


def test_both_ends_of_the_span_are_included(spark):
    seen = bronze(spark, *[{"timestamp": T0 + d, "bid_price": 1.0} for d in
                           (-6 * H - MICRO, -6 * H, -3 * H, -MICRO, 0 * H, MICRO)])
    paid = payments(spark, ("adv_001", "camp_001", T0), ("adv_001", "camp_002", T0), (None, "camp_001", T0),
                    ("adv_001", "camp_001", None))
    result = payment_reconciliation(paid, seen)
    assert matched(result) == [(4, 4.0), (0, 0.0), (0, 0.0), (0, 0.0)]
    assert [r.reconciled for r in result.orderBy("payment_id").collect()] == [True, False, False, False]


def test_equals_pairing_every_payment_with_every_impression(spark):
    draw = random.Random(7)

    def moment():
        return T0 + dt.timedelta(seconds=draw.randint(0, 30 * 3600), microseconds=draw.choice([0, 0, 1, 999_999]))

    seen = [(draw.choice("ab"), draw.choice("xy"), moment(), draw.randint(1, 999) / 1000) for _ in range(600)]
    paid = [(draw.choice("ab"), draw.choice("xyz"), moment()) for _ in range(99)]
    paid += [(a, c, t) for a, c, t, _ in seen[:20]] + [(a, c, t + 6 * H) for a, c, t, _ in seen[20:40]]
    expected = []
    for i, (adv, camp, at) in enumerate(paid):
        hits = [p for a, c, t, p in seen if (a, c) == (adv, camp) and at - 6 * H <= t <= at]
        expected.append((f"p{i}", len(hits), round(sum(hits), 4)))
    rows = bronze(spark, *[{"advertiser_id": a, "campaign_id": c, "timestamp": t, "bid_price": p} for a, c, t, p in seen])
    got = collect(payment_reconciliation(payments(spark, *paid), rows), "payment_id", "matched_impressions", "matched_spend")
    assert got == sorted(expected)


def test_no_pair_of_rows_is_joined(spark):
    plan = payment_reconciliation(payments(spark, ("a", "c", T0)), bronze(spark, {}))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1 and "Cross" not in text  # payments with minutes, which are unique


def test_repeated_payment_counts_once(spark):
    paid = payments(spark, ("adv_001", "camp_001", T0))
    assert matched(payment_reconciliation(paid.union(paid), bronze(spark, {}))) == [(1, 0.45)]


def test_engagement_by_content(spark):
    seen = bronze(spark, {"impression_id": "a"}, {"impression_id": "b"}, {"impression_id": "c", "content_id": "cnt_002"})
    engaged = spark.createDataFrame(
        [("e1", "u", "other", "a", 60, 0.5, True, T0), ("e2", "u", "cnt_001", "a", 30, 0.25, False, T0),
         ("e3", "u", "cnt_001", "unknown", 5, 0.1, True, T0), ("e4", "u", "cnt_001", None, 5, 0.1, True, T0)],
        ENGAGEMENT_SCHEMA)
    assert collect(engagement_by_content(engaged, seen)) == [
        ("cnt_001", 2, 2, 90, 0.375, 0.5), ("cnt_002", 1, 0, 0, None, 0.0)]


def test_repeated_engagement_counts_once(spark):
    seen = bronze(spark, {"impression_id": "a"})
    engaged = spark.createDataFrame(
        [("e1", "u", "c", "a", 60, 0.5, True, T0), ("e1", "u", "c", "a", 60, 0.5, True, T0),
         ("e1", "u", "c", "a", 70, 0.5, True, T0 + H), (None, "u", "c", "a", 1, None, False, T0),
         (None, "u", "c", "a", 1, None, False, T0)],
        ENGAGEMENT_SCHEMA)
    assert collect(engagement_by_content(engaged, seen)) == [("cnt_001", 1, 3, 62, 0.5, 1.0)]


def test_a_completion_rate_that_is_not_finite_counts_as_missing(spark):
    from adlumen.schemas import ENGAGEMENT_SCHEMA

    def sent(name, rate):
        return (name, "u", "cnt_001", "imp_0", 10, rate, True, T0)

    engagements = spark.createDataFrame([sent("a", float("inf")), sent("b", float("nan")), sent("c", 0.5), sent("d", None)], ENGAGEMENT_SCHEMA)
    row = engagement_by_content(engagements, bronze(spark, {})).first()
    assert (row.engagements, row.avg_completion_rate) == (4, 0.5)
