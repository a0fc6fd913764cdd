"""The same queries as plain SQL over the star-schema tables, for DuckDB.

Written from the definitions, not from the Spark plans: duplicates by a union, modes and the
interval match by the plain window or join. Shared parts are chains of common table expressions.
"""

from __future__ import annotations


def _id(prefix: str, number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"concat('{prefix}', lpad({digits}, CAST(greatest({width}, length({digits})) AS INTEGER), '0'))"


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


def _round(value: str, places: int) -> str:
    """Half-up rounding of decimal digits; DuckDB rounds the binary value of a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(30, 10)), {places}) AS DOUBLE)"


def _sum(column: str, places: int = 4) -> str:
    return f"sum(CAST({column} AS DECIMAL(18, {places})))"


_SPEND = _sum("bid_price", 6)
_COUNTRIES = ["US", "GB", "KE", "DE", "FR", "NG", "ZA", "IN", "BR", "CA"]
_CURRENCIES = ["USD", "EUR", "GBP", "KES", "NGN", "ZAR", "INR", "BRL", "CAD"]
_PROFILE_CURRENCIES = ["USD", "GBP", "KES", "EUR", "EUR", "NGN", "ZAR", "INR", "BRL", "CAD"]

_ADVERTISER = _id("adv_", "event_id * 31 % 997 % 20 + 1", 3)
_CAMPAIGN = _id("camp_", "event_id * 17 % 991 % 50 + 1", 3)
_CONTENT = _id("cnt_", "event_id * 13 % 983 % 100 + 1", 3)

# --- common table expressions -------------------------------------------------------------

SOURCE = f"""
first_delivery AS (
  SELECT event_id, 0 AS copy, ts AS "timestamp", user_id AS uid, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) >= 97 AS is_fraud
  FROM events),
delivered AS (
  SELECT * FROM first_delivery
  UNION ALL
  SELECT event_id, 1, "timestamp" + INTERVAL 1 SECOND, uid, event_type, value, is_fraud
  FROM first_delivery WHERE event_id % 50 = 0),
source AS (
  SELECT event_id, copy,
    {_id("imp_", "event_id", 10)} AS impression_id,
    CASE WHEN is_fraud THEN {_id("bot_", "event_id % 10 + 1", 3)}
         WHEN event_id % 211 = 0 THEN NULL
         ELSE {_id("user_", "uid", 6)} END AS user_id,
    {_ADVERTISER} AS advertiser_id,
    {_CAMPAIGN} AS campaign_id,
    {_CONTENT} AS content_id,
    CASE WHEN event_id % 307 <> 0 THEN value / 5 END AS bid_price,
    CASE WHEN event_id % 40 = 39 THEN 'JPY' ELSE {_pick("event_id % 9", _CURRENCIES)} END AS currency,
    CASE WHEN event_id % 37 = 0 THEN 'XX' WHEN event_id % 401 = 0 THEN NULL
         ELSE {_pick("event_id * 7 % 101 % 10", _COUNTRIES)} END AS country_code,
    CASE event_type WHEN 'view' THEN 'mobile' WHEN 'click' THEN 'desktop' WHEN 'signup' THEN 'tablet'
         WHEN 'purchase' THEN 'ctv' WHEN 'error' THEN 'desktop' END AS device_type,
    {_pick("event_id * 11 % 103 % 4", ["banner", "video", "native", "audio"])} AS ad_format,
    "timestamp", is_fraud, CAST("timestamp" AS DATE) AS ingestion_date
  FROM delivered),
bronze AS (SELECT * EXCLUDE (event_id, copy) FROM source)"""

PROFILES = f"""
profiles AS (
  SELECT {_id("user_", "c_custkey", 6)} AS user_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'free' WHEN 'AUTOMOBILE' THEN 'free'
         WHEN 'MACHINERY' THEN 'basic' WHEN 'HOUSEHOLD' THEN 'premium'
         WHEN 'FURNITURE' THEN 'enterprise' END AS account_tier,
    {_pick("c_nationkey % 10", _COUNTRIES)} AS registration_country,
    {_pick("c_nationkey % 10", _PROFILE_CURRENCIES)} AS preferred_currency,
    c_acctbal > 0 AS is_verified,
    TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM customer WHERE c_custkey % 29 <> 0)"""

DEDUPED = SOURCE + """,
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY "timestamp") AS rn FROM bronze)
  WHERE rn = 1)"""

FLAGGED = DEDUPED + """,
flagged AS (
  SELECT *, concat_ws(', ',
      CASE WHEN bid_price IS NULL THEN 'null_bid_price' END,
      CASE WHEN user_id IS NULL THEN 'null_user_id' END,
      CASE WHEN country_code NOT IN ('US','GB','KE','DE','FR','NG','ZA','IN','BR','CA') THEN 'invalid_country' END,
      CASE WHEN currency NOT IN ('USD','EUR','GBP','KES','NGN','ZAR','INR','BRL','CAD') THEN 'invalid_currency' END,
      CASE WHEN bid_price > 50 THEN 'bid_price_exceeds_threshold' END) AS quality_issues
  FROM deduped),
clean AS (SELECT * EXCLUDE (quality_issues) FROM flagged WHERE quality_issues = ''),
quarantine AS (SELECT * FROM flagged WHERE quality_issues <> '')"""

SILVER = FLAGGED + "," + PROFILES + """,
enriched AS (
  SELECT c.*, p.account_tier, p.registration_country, p.preferred_currency, p.is_verified
  FROM clean c LEFT JOIN profiles p ON c.user_id = p.user_id),
legitimate AS (SELECT * FROM enriched WHERE is_fraud = false),
fraud AS (SELECT * FROM enriched WHERE is_fraud = true)"""

_HOURLY = f"""
  SELECT advertiser_id, date_trunc('hour', "timestamp") AS hour,
    {_round(_SPEND, 4)} AS total_spend,
    count(impression_id) AS impression_count,
    {_round(_SPEND + ' / count(impression_id) * 1000', 4)} AS avg_cpm,
    count(*) FILTER (WHERE device_type = 'mobile') AS mobile_impressions,
    count(*) FILTER (WHERE ad_format = 'video') AS video_impressions,
    count(DISTINCT campaign_id) AS unique_campaigns,
    CAST(min("timestamp") AS DATE) AS ingestion_date
  FROM legitimate GROUP BY ALL"""

REVENUE = SILVER + f""",
hourly AS ({_HOURLY}),
revenue AS (
  SELECT *, CAST(rank() OVER (PARTITION BY hour ORDER BY total_spend DESC) AS INTEGER) AS spend_rank_in_hour
  FROM hourly)"""


def _top(table: str, keys: str, column: str, name: str) -> str:
    return f"""
  SELECT {keys}, {column} AS {name} FROM (
    SELECT {keys}, {column}, row_number() OVER (
      PARTITION BY {keys} ORDER BY count(*) DESC, {column} ASC NULLS LAST) AS rn
    FROM {table} GROUP BY {keys}, {column})
  WHERE rn = 1"""


_DAY = "content_id, ingestion_date"

CONTENT = SILVER + f""",
core AS (
  SELECT {_DAY},
    count(impression_id) AS total_impressions,
    {_round(_SPEND, 4)} AS total_revenue,
    {_round(_SPEND + ' / count(impression_id) * 1000', 4)} AS avg_cpm,
    {_round("avg(CASE WHEN account_tier IN ('premium', 'enterprise') THEN 1 ELSE 0 END)", 4)} AS premium_user_rate,
    {_round('avg(CASE WHEN is_verified THEN 1 ELSE 0 END)', 4)} AS verified_user_rate
  FROM legitimate GROUP BY {_DAY}),
top_device AS ({_top("legitimate", _DAY, "device_type", "top_device")}),
top_country AS ({_top("legitimate", _DAY, "country_code", "top_country")}),
top_format AS ({_top("legitimate", _DAY, "ad_format", "top_ad_format")}),
content AS (
  SELECT core.*, top_device, top_country, top_ad_format FROM core
  LEFT JOIN top_device USING (content_id, ingestion_date)
  LEFT JOIN top_country USING (content_id, ingestion_date)
  LEFT JOIN top_format USING (content_id, ingestion_date))"""

FRAUD = SILVER + f""",
daily AS (
  SELECT ingestion_date,
    count(impression_id) AS fraud_impression_count,
    {_round(_SPEND, 4)} AS fraud_revenue_at_risk,
    {_round(_SPEND + ' / count(bid_price)', 4)} AS avg_fraud_bid_price,
    count(DISTINCT advertiser_id) AS advertisers_targeted,
    count(DISTINCT country_code) AS countries_affected
  FROM fraud GROUP BY ingestion_date),
top_advertiser AS ({_top("fraud", "ingestion_date", "advertiser_id", "top_targeted_advertiser")}),
fraud_days AS (SELECT daily.*, top_targeted_advertiser FROM daily LEFT JOIN top_advertiser USING (ingestion_date))"""

# What validation makes of the messages: the defects are put in as columns instead of text.
MESSAGES = SOURCE + """,
sent AS (
  SELECT *,
    event_id % 53 = 0 AS bad_json,
    event_id % 59 = 0 OR (user_id IS NULL) AS no_user,
    event_id % 59 <> 0 AND user_id IS NOT NULL AND event_id % 73 = 0 AS number_user,
    event_id % 61 = 0 OR coalesce(bid_price <= 0, false) AS negative_bid,
    event_id % 61 <> 0 AND bid_price IS NULL AS no_bid,
    currency NOT IN ('USD','EUR','GBP','KES') AS bad_currency,
    event_id % 67 = 0 AS long_country,
    event_id % 67 <> 0 AND country_code IS NULL AS no_country
  FROM source),
checked AS (
  SELECT event_id, copy,
    CASE WHEN NOT bad_json AND event_id % 79 <> 0 THEN impression_id END AS impression_id,
    CASE WHEN NOT (bad_json OR no_user OR number_user) THEN user_id END AS user_id,
    CASE WHEN NOT bad_json THEN advertiser_id END AS advertiser_id,
    CASE WHEN NOT bad_json THEN campaign_id END AS campaign_id,
    CASE WHEN NOT bad_json THEN content_id END AS content_id,
    CASE WHEN NOT (bad_json OR negative_bid OR no_bid) THEN round(bid_price, 6) END AS bid_price,
    CASE WHEN NOT (bad_json OR bad_currency) THEN currency END AS currency,
    CASE WHEN NOT (bad_json OR long_country OR no_country) THEN country_code END AS country_code,
    CASE WHEN NOT bad_json THEN device_type END AS device_type,
    CASE WHEN NOT bad_json THEN ad_format END AS ad_format,
    CASE WHEN NOT bad_json THEN "timestamp" END AS "timestamp",
    CASE WHEN NOT bad_json THEN is_fraud END AS is_fraud,
    CASE WHEN bad_json THEN 'malformed_json' ELSE concat_ws(',',
      CASE WHEN no_user THEN 'missing_user_id' WHEN number_user THEN 'invalid_user_id' END,
      CASE WHEN negative_bid THEN 'invalid_bid_price' WHEN no_bid THEN 'missing_bid_price' END,
      CASE WHEN bad_currency THEN 'invalid_currency' END,
      CASE WHEN long_country THEN 'invalid_country_code' WHEN no_country THEN 'missing_country_code' END)
    END AS errors
  FROM sent)"""

PAYMENTS = f"""
payments AS (
  SELECT event_id, {_id("pay_", "event_id", 10)} AS payment_id, {_ADVERTISER} AS advertiser_id,
    {_CAMPAIGN} AS campaign_id, round(value * 10, 2) AS amount,
    {_pick("event_id % 4", ["USD", "EUR", "GBP", "KES"])} AS currency,
    {_id("batch_", "event_id", 10)} AS impression_batch_id,
    CASE WHEN event_id % 100 = 77 THEN 'failed' WHEN event_id % 10 <= 6 THEN 'settled'
         WHEN event_id % 10 <= 8 THEN 'pending' ELSE 'disputed' END AS payment_status,
    ts + to_hours(CAST(event_id % 12 AS INTEGER)) AS "timestamp"
  FROM events WHERE event_type = 'purchase')"""

ENGAGEMENTS = f"""
engagements AS (
  SELECT event_id, {_id("eng_", "event_id", 10)} AS engagement_id, {_id("user_", "user_id", 6)} AS user_id,
    {_CONTENT} AS content_id, {_id("imp_", "event_id", 10)} AS impression_id,
    CAST(event_id * 97 % 1801 AS INTEGER) AS watch_duration_seconds,
    round((event_id * 97 % 1801) / 1800, 4) AS completion_rate,
    event_type = 'click' AS clicked, ts + INTERVAL 30 SECOND AS "timestamp"
  FROM events WHERE event_type IN ('click', 'view'))"""

# --- queries ------------------------------------------------------------------------------

_CTES_AND_SELECTS = {
    "bronze_impressions": (SOURCE, "SELECT * FROM bronze"),
    "scan_bronze": (SOURCE, "SELECT * FROM bronze WHERE ingestion_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"),
    "bronze_row_count": (SOURCE, "SELECT count(*) AS row_count FROM bronze"),
    "user_profiles": (PROFILES, "SELECT * FROM profiles"),
    "parse_json_events": (SOURCE, """
        SELECT event_id, copy, event_id % 53 = 0 AS is_malformed,
          CASE WHEN event_id % 53 <> 0 THEN advertiser_id END AS advertiser_id,
          CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 61 = 0 THEN -1.0::DOUBLE ELSE bid_price END AS bid_price,
          CASE WHEN event_id % 53 <> 0 THEN "timestamp" END AS "timestamp"
        FROM source"""),
    "publish_projection": (SOURCE, """
        SELECT advertiser_id AS key, impression_id, bid_price, currency, country_code, "timestamp", is_fraud
        FROM bronze"""),
    "validate_impressions": (MESSAGES, "SELECT * FROM checked"),
    "validate_payments": (PAYMENTS, """
        SELECT event_id, payment_id, advertiser_id, campaign_id,
          CASE WHEN event_id % 13 <> 0 AND amount > 0 THEN amount END AS amount,
          currency, impression_batch_id,
          CASE WHEN event_id % 17 <> 0 THEN payment_status END AS payment_status, "timestamp",
          concat_ws(',', CASE WHEN event_id % 13 = 0 OR amount <= 0 THEN 'invalid_amount' END,
                         CASE WHEN event_id % 17 = 0 THEN 'invalid_payment_status' END) AS errors
        FROM payments"""),
    "validate_engagements": (ENGAGEMENTS, """
        SELECT event_id, engagement_id, user_id, content_id, impression_id, watch_duration_seconds,
          CASE WHEN event_id % 13 <> 0 THEN completion_rate END AS completion_rate,
          CASE WHEN event_id % 17 <> 0 THEN clicked END AS clicked, "timestamp",
          concat_ws(',', CASE WHEN event_id % 13 = 0 THEN 'invalid_completion_rate' END,
                         CASE WHEN event_id % 17 = 0 THEN 'missing_clicked' END) AS errors
        FROM engagements"""),
    "ingest_valid": (MESSAGES, """
        SELECT * EXCLUDE (event_id, copy, errors), CAST("timestamp" AS DATE) AS ingestion_date
        FROM checked WHERE errors = ''"""),
    "ingest_rejected": (MESSAGES, "SELECT event_id, copy, errors FROM checked WHERE errors <> ''"),
    "ingest_stats": (MESSAGES, f"""
        SELECT count(*) FILTER (WHERE errors = '') AS valid_count,
          count(*) FILTER (WHERE errors <> '') AS invalid_count,
          count(*) FILTER (WHERE errors = '' AND is_fraud) AS fraud_count,
          {_round("count(*) FILTER (WHERE errors = '' AND is_fraud) / count(*) FILTER (WHERE errors = '')", 4)} AS fraud_rate
        FROM checked"""),
    "fraud_alerts": (MESSAGES, """
        SELECT impression_id, user_id, bid_price, advertiser_id FROM checked WHERE errors = '' AND is_fraud"""),
    "dedup_impressions": (DEDUPED, "SELECT * FROM deduped"),
    "dedup_stats": (DEDUPED, """
        SELECT (SELECT count(*) FROM bronze) AS rows_before, (SELECT count(*) FROM deduped) AS rows_after,
          (SELECT count(*) FROM bronze) - (SELECT count(*) FROM deduped) AS duplicates_removed"""),
    "quality_flags": (FLAGGED, "SELECT impression_id, quality_issues FROM flagged"),
    "quality_stats": (FLAGGED, """
        SELECT (SELECT count(*) FROM clean) AS clean, (SELECT count(*) FROM quarantine) AS quarantined"""),
    "silver_clean": (FLAGGED, "SELECT * FROM clean"),
    "silver_quarantine": (FLAGGED, "SELECT * FROM quarantine"),
    "quarantine_sample": (FLAGGED, """
        SELECT impression_id, quality_issues FROM quarantine ORDER BY impression_id LIMIT 3"""),
    "enrich_profiles": (SILVER, "SELECT * FROM enriched"),
    "missing_profiles": (SILVER, "SELECT impression_id, user_id FROM enriched WHERE account_tier IS NULL"),
    "enrich_stats": (SILVER, """
        SELECT count(*) AS total, count(*) FILTER (WHERE account_tier IS NULL) AS missing_profiles FROM enriched"""),
    "split_stats": (SILVER, f"""
        SELECT (SELECT count(*) FROM legitimate) AS legitimate, (SELECT count(*) FROM fraud) AS fraud,
          (SELECT count(*) FROM enriched WHERE is_fraud IS NULL) AS unflagged,
          {_round('(SELECT count(*) FROM fraud) / (SELECT count(*) FROM enriched)', 4)} AS fraud_rate"""),
    "silver_legitimate": (SILVER, "SELECT * FROM legitimate"),
    "silver_fraud": (SILVER, "SELECT * FROM fraud"),
    "revenue_by_advertiser": (REVENUE, "SELECT * FROM revenue"),
    "content_core": (CONTENT, "SELECT * FROM core"),
    "content_top_device": (CONTENT, "SELECT * FROM top_device"),
    "content_top_country": (CONTENT, "SELECT * FROM top_country"),
    "content_top_format": (CONTENT, "SELECT * FROM top_format"),
    "content_performance": (CONTENT, "SELECT * FROM content"),
    "fraud_daily": (FRAUD, "SELECT * FROM daily"),
    "fraud_top_advertiser": (FRAUD, "SELECT * FROM top_advertiser"),
    "fraud_summary": (FRAUD, "SELECT * FROM fraud_days"),
    "fraud_by_country": (SILVER, f"""
        SELECT ingestion_date, country_code, count(impression_id) AS fraud_impression_count,
          {_round(_SPEND, 4)} AS fraud_revenue_at_risk
        FROM fraud GROUP BY ingestion_date, country_code"""),
    "dash_summary": (CONTENT + FRAUD[len(SILVER):], f"""
        SELECT (SELECT {_round(_sum('total_revenue'), 2)} FROM content) AS total_revenue,
          CAST((SELECT sum(total_impressions) FROM content) AS BIGINT) AS total_impressions,
          CAST((SELECT sum(fraud_impression_count) FROM fraud_days) AS BIGINT) AS total_fraud,
          (SELECT {_round(_sum('fraud_revenue_at_risk'), 4)} FROM fraud_days) AS fraud_revenue_at_risk,
          (SELECT count(DISTINCT content_id) FROM content) AS active_content"""),
    "dash_top_advertisers": (REVENUE, """
        SELECT advertiser_id, hour, total_spend, impression_count, avg_cpm FROM revenue
        ORDER BY total_spend DESC, advertiser_id, hour LIMIT 10"""),
    "dash_cpm_top8": (REVENUE, """
        SELECT advertiser_id, hour, avg_cpm FROM revenue ORDER BY total_spend DESC, advertiser_id, hour LIMIT 8"""),
    "dash_top_content": (CONTENT, f"""
        SELECT content_id, ingestion_date, total_revenue, total_impressions, avg_cpm, top_device, top_country,
          top_ad_format, {_round('premium_user_rate * 100', 1)} AS premium_user_pct,
          {_round('verified_user_rate * 100', 1)} AS verified_user_pct
        FROM content ORDER BY total_revenue DESC, content_id, ingestion_date LIMIT 15"""),
    "dash_fraud_latest": (FRAUD, "SELECT * FROM fraud_days ORDER BY ingestion_date DESC LIMIT 1"),
    "dash_fraud_rollup": (FRAUD, f"""
        SELECT CAST(sum(fraud_impression_count) AS BIGINT) AS fraud_impression_count,
          {_round(_sum('fraud_revenue_at_risk'), 2)} AS fraud_revenue_at_risk,
          {_round(_sum('avg_fraud_bid_price') + ' / count(*)', 2)} AS avg_fraud_bid_price,
          {_round(_sum('fraud_revenue_at_risk') + ' / sum(fraud_impression_count)', 2)} AS weighted_avg_bid_price,
          max(advertisers_targeted) AS advertisers_targeted, max(countries_affected) AS countries_affected,
          arg_max(top_targeted_advertiser, ingestion_date) AS top_targeted_advertiser,
          count(*) AS fraud_days
        FROM fraud_days"""),
    "dash_device_split": (CONTENT, f"""
        SELECT top_device, {_round(_sum('total_revenue'), 2)} AS total_revenue, count(*) AS content_count
        FROM content GROUP BY top_device"""),
    "dash_country_revenue": (CONTENT, f"""
        SELECT top_country, {_round(_sum('total_revenue'), 2)} AS total_revenue, count(*) AS content_count
        FROM content GROUP BY top_country"""),
    "quality_gate": (REVENUE, f"""
        , figures AS (
          SELECT (SELECT count(*) FROM legitimate) AS silver_rows, (SELECT count(*) FROM revenue) AS gold_rows,
            (SELECT count(*) FROM bronze) AS bronze_rows,
            (SELECT count(*) FROM bronze WHERE is_fraud = true) AS fraud_rows)
        SELECT *, silver_rows > 0 AS silver_not_empty, gold_rows > 0 AS gold_not_empty,
          fraud_rows / bronze_rows < 0.10 AS fraud_rate_ok, {_round('fraud_rows / bronze_rows', 4)} AS fraud_rate,
          silver_rows > 0 AND gold_rows > 0 AND fraud_rows / bronze_rows < 0.10 AS passed
        FROM figures"""),
    "null_rates": (SOURCE, " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count("{c}") AS null_count,
              {_round(f'(count(*) - count("{c}")) / count(*)', 4)} AS null_rate,
              (count(*) - count("{c}")) / count(*) <= 0.05 AS within_limit FROM bronze"""
        for c in ["impression_id", "user_id", "advertiser_id", "campaign_id", "content_id", "bid_price",
                  "currency", "country_code", "device_type", "ad_format", "timestamp", "is_fraud"])),
    "payment_reconciliation": (SILVER + "," + PAYMENTS, f"""
        SELECT p.payment_id, p.advertiser_id, p.campaign_id, p.amount, p.payment_status, p."timestamp",
          count(i.advertiser_id) AS matched_impressions,
          {_round('coalesce(' + _sum('i.bid_price', 6) + ', 0)', 4)} AS matched_spend,
          count(i.advertiser_id) > 0 AS reconciled
        FROM payments p LEFT JOIN legitimate i
          ON i.advertiser_id = p.advertiser_id AND i.campaign_id = p.campaign_id
         AND i."timestamp" BETWEEN p."timestamp" - INTERVAL 6 HOUR AND p."timestamp"
        GROUP BY ALL"""),
    "engagement_by_content": (SILVER + "," + ENGAGEMENTS, f"""
        SELECT i.content_id, count(DISTINCT i.impression_id) AS impressions, count(e.engagement_id) AS engagements,
          CAST(coalesce(sum(e.watch_duration_seconds), 0) AS BIGINT) AS watch_seconds,
          {_round(_sum('e.completion_rate') + ' / count(e.completion_rate)', 4)} AS avg_completion_rate,
          {_round('count(*) FILTER (WHERE e.clicked) / count(DISTINCT i.impression_id)', 4)} AS click_rate
        FROM legitimate i LEFT JOIN engagements e ON e.impression_id = i.impression_id
        GROUP BY i.content_id"""),
    "sink_bronze_append": (SOURCE, "SELECT * FROM bronze"),
    "sink_bronze_compacted": (SOURCE, "SELECT * FROM bronze"),
    "sink_silver": (SILVER, """
        SELECT CASE WHEN is_fraud THEN 'fraud' ELSE 'legitimate' END AS outcome,
          * EXCLUDE (registration_country, preferred_currency), NULL AS quality_issues
        FROM enriched
        UNION ALL BY NAME
        SELECT 'quarantine' AS outcome, * FROM quarantine"""),
    "sink_gold": (REVENUE, "SELECT * FROM revenue"),
    "sink_gold_content": (CONTENT, "SELECT * FROM content"),
    "sink_gold_fraud": (FRAUD, "SELECT * FROM fraud_days"),
    "ingest_topic_frame": (MESSAGES, """
        SELECT 'valid' AS outcome, 'ads/0/' || event_id AS position, NULL AS errors,
          * EXCLUDE (event_id, copy, errors, impression_id)
        FROM checked WHERE errors = ''
        UNION ALL BY NAME
        SELECT 'rejected' AS outcome, 'ads/0/' || event_id AS position, errors FROM checked WHERE errors <> ''"""),
    "stream_bronze_ingest": (MESSAGES, """
        SELECT 'valid' AS outcome, NULL AS errors, * EXCLUDE (event_id, copy, errors, impression_id)
        FROM checked WHERE errors = ''
        UNION ALL BY NAME
        SELECT 'rejected' AS outcome, errors FROM checked WHERE errors <> ''"""),
    "stream_dedup": (DEDUPED, 'SELECT * EXCLUDE ("timestamp", ingestion_date) FROM deduped'),
    "stream_hourly_revenue": (REVENUE, """
        SELECT * EXCLUDE (ingestion_date, spend_rank_in_hour) FROM revenue
        WHERE hour + INTERVAL 1 HOUR <= (SELECT max("timestamp") - INTERVAL 1 HOUR FROM bronze)"""),
}

_MOMENT = "TIMESTAMP '{}' + to_minutes(CAST(k % 1000 AS INTEGER))"
_HISTORY = PROFILES + f""",
keyed AS (SELECT *, CAST(substr(user_id, 6) AS BIGINT) AS k FROM profiles),
feed AS (
  SELECT *, 'insert' AS op, {_MOMENT.format("2024-01-02 00:00:00")} AS changed_at FROM keyed
  UNION ALL SELECT * REPLACE ('premium' AS account_tier), 'update', {_MOMENT.format("2024-01-09 06:00:00")} FROM keyed WHERE k % 3 = 0
  UNION ALL SELECT * REPLACE ('enterprise' AS account_tier), 'update', {_MOMENT.format("2024-01-18 06:00:00")} FROM keyed WHERE k % 3 = 0
  UNION ALL SELECT *, 'delete', {_MOMENT.format("2024-01-24 06:00:00")} FROM keyed WHERE k % 11 = 0),
ranges AS (
  SELECT * EXCLUDE (op) FROM (
    SELECT user_id, account_tier, registration_country, preferred_currency, is_verified, op, changed_at AS valid_from,
      lead(changed_at) OVER (PARTITION BY user_id ORDER BY changed_at) AS valid_to
    FROM feed) WHERE op <> 'delete')"""
_CTES_AND_SELECTS["apply_profile_changes"] = (_HISTORY, "SELECT * FROM ranges")
_CTES_AND_SELECTS["enrich_as_of"] = (FLAGGED + "," + _HISTORY, """
    SELECT c.*, r.account_tier, r.registration_country, r.preferred_currency, r.is_verified
    FROM clean c LEFT JOIN ranges r ON r.user_id = c.user_id AND r.valid_from <= c."timestamp"
      AND (r.valid_to IS NULL OR c."timestamp" < r.valid_to)""")
_CTES_AND_SELECTS["fraud_sessions"] = (SILVER, f"""
    SELECT user_id, min("timestamp") AS started, max("timestamp") AS ended, count(*) AS impressions, {_round(_SPEND, 4)} AS revenue_at_risk
    FROM (
      SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS burst
      FROM (
        SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp") <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS begins
        FROM fraud))
    GROUP BY user_id, burst""")
_CTES_AND_SELECTS["bid_price_drift"] = (SOURCE, """
    , bins AS (
      SELECT ingestion_date, CAST(ceil(ln(bid_price) / ln((1 + 0.01) / CAST(1 - 0.01 AS DOUBLE))) AS BIGINT) AS bin, count(*) AS n
      FROM bronze WHERE bid_price > 0 AND isfinite(bid_price) GROUP BY ALL),
    days AS (SELECT ingestion_date, lag(ingestion_date) OVER (ORDER BY ingestion_date) AS before FROM (SELECT DISTINCT ingestion_date FROM bins)),
    edges AS (SELECT d.ingestion_date, d.before, e.bin FROM days d JOIN (SELECT DISTINCT ingestion_date, bin FROM bins) e ON e.ingestion_date IN (d.ingestion_date, d.before) GROUP BY ALL),
    shares AS (
      SELECT e.ingestion_date, e.bin,
        (SELECT sum(n) FROM bins b WHERE b.ingestion_date = e.ingestion_date) AS total,
        (SELECT coalesce(sum(n), 0) FROM bins b WHERE b.ingestion_date = e.ingestion_date AND b.bin <= e.bin) AS below,
        (SELECT sum(n) FROM bins b WHERE b.ingestion_date = e.before) AS total_before,
        (SELECT coalesce(sum(n), 0) FROM bins b WHERE b.ingestion_date = e.before AND b.bin <= e.bin) AS below_before
      FROM edges e)
    SELECT ingestion_date, CAST(max(total) AS BIGINT) AS prices,
      round(2 * pow(1.01 / CAST(0.99 AS DOUBLE), min(bin) FILTER (WHERE below >= 0.5 * total)) / (1.01 / CAST(0.99 AS DOUBLE) + 1), 4) AS median_price,
      round(2 * pow(1.01 / CAST(0.99 AS DOUBLE), min(bin) FILTER (WHERE below >= 0.95 * total)) / (1.01 / CAST(0.99 AS DOUBLE) + 1), 4) AS p95_price,
      round(max(abs(below / total - below_before / total_before)), 6) AS distance,
      coalesce(round(max(abs(below / total - below_before / total_before)), 6) <= 0.1, true) AS within_limit
    FROM shares GROUP BY ingestion_date""")

_CTES_AND_SELECTS["distinct_over_range"] = (SILVER, " UNION ALL ".join(
    f"""SELECT '{name}' AS range, count(DISTINCT user_id) AS user_id, count(DISTINCT advertiser_id) AS advertiser_id,
          count(DISTINCT campaign_id) AS campaign_id, count(DISTINCT content_id) AS content_id,
          true AS user_id_near, true AS advertiser_id_near, true AS campaign_id_near, true AS content_id_near
        FROM legitimate WHERE ingestion_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-{last:02}'"""
    for name, last in (("day", 3), ("week", 9), ("month", 31))))

_CTES_AND_SELECTS["stream_top_advertisers"] = (SOURCE, """
    , spent AS (
      SELECT advertiser_id, count(*) AS impression_count,
        coalesce(sum(CAST(round_even(bid_price * 1000000, 0) AS BIGINT)) FILTER (WHERE bid_price > 0 AND isfinite(bid_price)), 0) AS micros
      FROM bronze WHERE advertiser_id IS NOT NULL GROUP BY advertiser_id)
    SELECT advertiser_id, round(micros / 1000000.0::DOUBLE, 4) AS total_spend, impression_count
    FROM spent ORDER BY micros DESC, advertiser_id LIMIT 10""")

for _name, _same in [("sink_silver_range", "sink_silver"), ("silver_incremental", "sink_silver"),
                     ("gold_incremental", "sink_gold"), ("stored_totals", "ingest_stats"),
                     ("stream_dedup_late", "stream_dedup"),
                     ("stream_payment_reconciliation", "payment_reconciliation")]:
    _CTES_AND_SELECTS[_name] = _CTES_AND_SELECTS[_same]

ORACLE: dict[str, str] = {
    name: f"WITH {ctes}\n{select}" for name, (ctes, select) in _CTES_AND_SELECTS.items()
}
