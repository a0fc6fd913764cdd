import datetime as dt
import json

from adlumen.operators import validate
from rows import MESSAGE, T0, collect, messages


def outcome(spark, *values, check=validate.validate_impressions):
    rows = check(messages(spark, *values)).orderBy("n").collect()
    return rows if len(rows) > 1 else rows[0]


def errors(spark, *values, check=validate.validate_impressions):
    return [list(r.errors) for r in check(messages(spark, *values)).orderBy("n").collect()]


def test_valid_impression_is_typed(spark):
    row = outcome(spark, {})
    assert row.errors == []
    assert (row.impression_id, row.bid_price, row.is_fraud, row.timestamp) == ("imp_1", 0.45, False, T0)


def test_country_is_upper_cased_and_must_have_two_characters(spark):
    good, long = outcome(spark, {"country_code": "ke"}, {"country_code": "KENYA"})
    assert good.country_code == "KE"
    assert long.errors == ["invalid_country_code"]


def test_price_must_be_positive(spark):
    assert errors(spark, {"bid_price": -0.5}, {"bid_price": 0.0}, {"bid_price": 0}) == [["invalid_bid_price"]] * 3


def test_price_is_rounded_to_six_places(spark):
    assert outcome(spark, {"bid_price": 0.12345678}).bid_price == 0.123457


def test_closed_vocabularies(spark):
    bad = [("currency", "NGN"), ("currency", "usd"), ("device_type", "phone"), ("ad_format", "popup")]
    assert errors(spark, *[{f: v} for f, v in bad]) == [[f"invalid_{f}"] for f, _ in bad]


def test_all_broken_rules_are_reported(spark):
    assert errors(spark, {"user_id": ..., "bid_price": -1, "currency": "JPY"}) == [
        ["missing_user_id", "invalid_bid_price", "invalid_currency"]]


def test_unrelated_object_misses_every_required_field(spark):
    (codes,) = errors(spark, '{"bad_field": "garbage"}')
    assert len(codes) == 9 and all(c.startswith("missing_") for c in codes)


def test_anything_but_one_json_object_is_malformed(spark):
    texts = ["not json", "", None, "5", "null", "[1]", '"text"', "[{}]", '{"user_id": "x"', "{} tail",
             "{} {}", "{},{}", "{}]", "{'user_id': 'x'}"]
    assert errors(spark, *texts) == [["malformed_json"]] * len(texts)
    assert all(r.is_malformed for r in validate.parse_events(messages(spark, *texts)).collect())


def test_parse_events_keeps_the_object(spark):
    row = validate.parse_events(messages(spark, {})).selectExpr(
        "is_malformed", "try_variant_get(event, '$.user_id', 'string') AS user").first()
    assert tuple(row) == (False, "user_000001")


def test_numeric_text_is_a_price_but_a_number_is_not_an_id(spark):
    text, word, number = outcome(
        spark, {"bid_price": " 0.45 "}, {"bid_price": "1.0d"}, {"user_id": 5})
    assert (text.bid_price, text.errors) == (0.45, [])
    assert word.errors == ["invalid_bid_price"]
    assert number.errors == ["invalid_user_id"]


def test_text_that_looks_like_another_type_is_still_text(spark):
    texts = ("5", "-1e3", "true", "[x]", "{y}", "NaN", "3f2a-11", "Ünï")
    rows = outcome(spark, *[{"user_id": user} for user in texts])
    assert [(r.user_id, r.errors) for r in rows] == [(user, []) for user in texts]
    others = (5, 1.5, True, [1], {"y": 1}, None)
    assert errors(spark, *[{"user_id": user} for user in others]) == [["invalid_user_id"]] * len(others)


def test_one_doubtful_field_does_not_change_the_others(spark):
    row = outcome(spark, {"user_id": "77", "bid_price": "1e-1", "is_fraud": "yes"})
    assert (row.user_id, row.bid_price, row.is_fraud, row.timestamp, row.errors) == ("77", 0.1, True, T0, [])


def test_defaults_apply_to_absent_fields_only(spark):
    a, b, null = outcome(
        spark, {"impression_id": ..., "timestamp": ..., "is_fraud": ...}, {"impression_id": ...},
        {"impression_id": None, "timestamp": None, "is_fraud": None})
    assert a.errors == b.errors == [] and a.is_fraud is False
    assert a.impression_id and b.impression_id and a.impression_id != b.impression_id
    assert abs(a.timestamp - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)
    assert null.errors == ["invalid_impression_id", "invalid_timestamp", "invalid_is_fraud"]


def test_null_is_invalid_not_missing(spark):
    assert errors(spark, {"user_id": None}, {"user_id": ...}) == [["invalid_user_id"], ["missing_user_id"]]


def test_timestamps(spark):
    cases = [
        ("2024-03-01T12:00:00Z", T0), ("2024-03-01T15:00:00+03:00", T0), ("2024-03-01 12:00:00", T0),
        ("2024-03-01T12:00:00.123456Z", T0.replace(microsecond=123456)), ("2024-03-01t12:00z", T0),
        ("2024-03-01", dt.datetime(2024, 3, 1)), (1709294400, T0), (1709294400000, T0), ("1709294400", T0),
        ("2024-03-01 12:00", T0), ("2024", dt.datetime(1970, 1, 1, 0, 33, 44)),
        ("2024-13-01T12:00:00Z", None), ("yesterday", None), (True, None)]
    rows = outcome(spark, *[{"timestamp": sent} for sent, _ in cases])
    assert [(r.timestamp, r.errors) for r in rows] == [
        (expected, [] if expected else ["invalid_timestamp"]) for _, expected in cases]


def test_booleans(spark):
    cases = [(True, True), ("true", True), ("No", False), (1, True), (0, False), ("maybe", None), (2, None), ([], None)]
    rows = outcome(spark, *[{"is_fraud": sent} for sent, _ in cases])
    assert [(r.is_fraud, r.errors) for r in rows] == [
        (expected, [] if expected is not None else ["invalid_is_fraud"]) for _, expected in cases]


def test_nan_price_passes_here_and_is_caught_in_silver(spark):
    from adlumen.operators import silver

    checked = validate.validate_impressions(messages(spark, {"bid_price": float("nan")}))
    assert '"bid_price": NaN' in checked.first().value and checked.first().errors == []
    flagged = silver.flag_quality(validate.bronze_rows(checked))
    assert flagged.first().quality_issues == "bid_price_exceeds_threshold"


def test_of_a_repeated_key_the_last_counts_and_unknown_fields_are_ignored(spark):
    row = outcome(spark, json.dumps(MESSAGE)[:-1] + ', "user_id": "user_000002", "extra": {"a": 1}}')
    assert (row.user_id, row.errors) == ("user_000002", [])


PAYMENT = {k: ... for k in ("impression_id", "user_id", "content_id", "bid_price", "country_code",
                            "device_type", "ad_format", "is_fraud")} | {
    "payment_id": "p", "amount": 1500.0, "impression_batch_id": "b", "payment_status": "settled"}


def test_payments(spark):
    good, negative, status = outcome(
        spark, PAYMENT, {**PAYMENT, "amount": -500.0}, {**PAYMENT, "payment_status": "lost"},
        check=validate.validate_payments)
    assert (good.amount, good.errors) == (1500.0, [])
    assert negative.errors == ["invalid_amount"] and status.errors == ["invalid_payment_status"]


ENGAGEMENT = {"engagement_id": "e", "watch_duration_seconds": 30, "completion_rate": 0.85, "clicked": True}


def test_engagements(spark):
    check = validate.validate_engagements
    good, high, low = outcome(
        spark, ENGAGEMENT, {**ENGAGEMENT, "completion_rate": 1.5}, {**ENGAGEMENT, "completion_rate": -0.1},
        check=check)
    assert (good.watch_duration_seconds, good.completion_rate, good.errors) == (30, 0.85, [])
    assert high.errors == low.errors == ["invalid_completion_rate"]
    cases = ((10.0, 10), ("10", 10), ("10.0", 10), (True, 1), (10.5, None), ("x", None))
    rows = outcome(spark, *[{**ENGAGEMENT, "watch_duration_seconds": sent} for sent, _ in cases], check=check)
    assert [r.watch_duration_seconds for r in rows] == [seconds for _, seconds in cases]


def test_split_and_stats(spark):
    checked = validate.validate_impressions(messages(spark, {}, '{"bad": "data"}', {"is_fraud": True, "user_id": "bot_001"}))
    good, bad = validate.split_valid(checked)
    assert (good.count(), bad.count()) == (2, 1)
    assert tuple(validate.ingest_stats(checked).first()) == (2, 1, 1, 0.5)
    assert collect(validate.fraud_alerts(checked)) == [("imp_1", "bot_001", 0.45, "adv_001")]
    assert tuple(validate.ingest_stats(checked.limit(0)).first()) == (0, 0, 0, 0.0)


def test_rejected_filter_stays_above_the_field_lookups(spark):
    """Pushed below, it would repeat every lookup many times over."""
    rejected = validate.rejected(validate.validate_impressions(messages(spark, {}))).select("n", "errors")
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 4, plan
