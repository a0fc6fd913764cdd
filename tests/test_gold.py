import datetime as dt

from adlumen.operators import gold
from rows import T0, collect, silver

HOUR = dt.timedelta(hours=1)
DAY = T0.date()


def test_hourly_revenue(spark):
    rows = silver(
        spark, {"bid_price": 1.0}, {"bid_price": 2.0, "device_type": "ctv", "campaign_id": "c2"},
        {"bid_price": 0.5, "ad_format": "audio", "device_type": None},
        {"bid_price": 4.0, "timestamp": T0 + HOUR}, {"bid_price": 9.0, "advertiser_id": "adv_002"})
    assert collect(gold.revenue_by_advertiser(rows)) == [
        ("adv_001", T0, 3.5, 3, 1166.6667, 1, 2, 2, DAY, 2),
        ("adv_001", T0 + HOUR, 4.0, 1, 4000.0, 1, 1, 1, DAY, 1),
        ("adv_002", T0, 9.0, 1, 9000.0, 1, 1, 1, DAY, 1)]


def test_rank_uses_rounded_spend_and_leaves_gaps(spark):
    rows = silver(spark, *[{"advertiser_id": a, "bid_price": p} for a, p in
                           (("a", 1.00001), ("b", 1.00002), ("c", 0.5), ("d", 2.0))])
    ranks = collect(gold.revenue_by_advertiser(rows), "advertiser_id", "spend_rank_in_hour")
    assert ranks == [("a", 2), ("b", 2), ("c", 4), ("d", 1)]


def test_group_of_only_null_ids_has_no_cpm(spark):
    row = gold.revenue_by_advertiser(silver(spark, {"impression_id": None})).first()
    assert (row.impression_count, row.avg_cpm, row.total_spend) == (0, None, 0.45)


def test_sums_do_not_depend_on_row_order(spark):
    rows = silver(spark, *[{"bid_price": 0.1 + 0.000001 * i} for i in range(200)])
    results = {
        gold.revenue_by_advertiser(rows.repartition(n).sortWithinPartitions("impression_id")).first().total_spend
        for n in (1, 3, 7)}
    assert results == {round(sum(100_000 + i for i in range(200)) / 1e6, 4)}


def test_content_performance(spark):
    rows = silver(
        spark,
        {"device_type": "tablet", "country_code": "US", "account_tier": "premium", "is_verified": True},
        {"device_type": "ctv", "country_code": "KE", "account_tier": "free", "is_verified": True},
        {"device_type": "tablet", "country_code": "KE", "ad_format": "audio"},
        {"content_id": "cnt_002", "device_type": None, "bid_price": 2.0})
    expected = [
        ("cnt_001", DAY, 3, 1.35, 450.0, 0.3333, 0.6667, "tablet", "KE", "video"),
        ("cnt_002", DAY, 1, 2.0, 2000.0, 0.0, 0.0, None, "US", "video")]
    assert collect(gold.content_performance(rows)) == expected
    assert collect(gold.content_core(rows)) == [r[:7] for r in expected]
    assert collect(gold.content_top_device(rows), "top_device") == [("tablet",), (None,)]


def test_mode_ties_take_the_smallest_value_and_null_last(spark):
    rows = silver(spark, *[{"device_type": d, "country_code": c} for d, c in
                           (("tablet", None), ("ctv", "US"), ("mobile", None), (None, "US"))])
    assert gold.content_performance(rows).first().top_device == "ctv"
    assert gold.content_performance(rows).first().top_country == "US"
    more_nulls = silver(spark, {"country_code": None}, {"country_code": None}, {"country_code": "US"})
    assert gold.content_performance(more_nulls).first().top_country is None


def test_null_content_has_metrics_but_no_tops(spark):
    row = gold.content_performance(silver(spark, {"content_id": None}, {"content_id": None})).first()
    assert (row.content_id, row.total_impressions, row.top_device, row.top_country, row.top_ad_format) == (
        None, 2, None, None, None)


def test_content_reads_its_input_once_and_joins_nothing(spark, tmp_path):
    silver(spark, {}).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    for build in (gold.content_performance, gold.fraud_summary):
        plan = build(stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Join" not in plan
        assert "campaign_id" not in plan[plan.index("ReadSchema"):]


def test_fraud_summary(spark):
    fraud = silver(
        spark, {"advertiser_id": "b", "bid_price": 1.0}, {"advertiser_id": "b", "bid_price": 2.0, "country_code": "KE"},
        {"advertiser_id": "a", "bid_price": None, "country_code": None}, {"advertiser_id": None, "bid_price": 4.0},
        {"advertiser_id": "c", "timestamp": T0 + 24 * HOUR}, {"advertiser_id": "a", "timestamp": T0 + 24 * HOUR})
    expected = [
        (DAY, 4, 7.0, 2.3333, 2, 2, "b"),
        (DAY + dt.timedelta(days=1), 2, 0.9, 0.45, 2, 1, "a")]
    assert collect(gold.fraud_summary(fraud)) == expected
    assert collect(gold.fraud_daily(fraud)) == [r[:6] for r in expected]
    assert collect(gold.fraud_top_advertiser(fraud)) == [(r[0], r[6]) for r in expected]
    assert collect(gold.fraud_by_country(fraud), "country_code", "fraud_impression_count") == [
        ("KE", 1), ("US", 2), ("US", 2), (None, 1)]


def test_null_day_has_no_top_advertiser(spark):
    row = gold.fraud_summary(silver(spark, {"timestamp": None})).first()
    assert (row.ingestion_date, row.fraud_impression_count, row.top_targeted_advertiser) == (None, 1, None)


def test_prices_beyond_all_bounds_do_not_end_the_run(spark):
    rows = silver(spark, {"bid_price": 1.0}, {"bid_price": float("-inf")}, {"bid_price": -1e300})
    row = gold.revenue_by_advertiser(rows).first()
    assert (row.total_spend, row.impression_count) == (1.0, 3)
