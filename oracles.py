"""DuckDB statements that state independently what each registered query must return."""

from __future__ import annotations

TX = """
SELECT concat('tx_', cast(event_id AS varchar)) AS transaction_id,
  make_timestamp((epoch_us(ts) - epoch_us(ts) % 86400000000 + (epoch_us(ts) % 86400000000) // 200 + (user_id % 24) * 3600000000)) AS event_time,
  concat('usr_', cast(user_id AS varchar)) AS user_id, concat('acc_', cast(user_id AS varchar)) AS account_id,
  round(value * 250, 2) AS amount, 'INR' AS currency,
  concat('m_', cast((event_id * 7) % 23 AS varchar)) AS merchant_id,
  CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'electronics' WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'jewelry'
       WHEN event_type = 'click' THEN 'groceries' WHEN event_type = 'view' THEN 'coffee' WHEN event_type = 'error' THEN 'fuel' ELSE 'food_delivery' END AS merchant_category,
  CASE event_id % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CREDIT_CARD' WHEN 2 THEN 'DEBIT_CARD' ELSE 'NETBANKING' END AS payment_method,
  concat('dev_', cast(user_id * 100 + (CASE WHEN event_id % 17 = 0 THEN event_id % 97 + 1 ELSE 0 END) AS varchar)) AS device_id,
  concat('10.20.', cast(event_id % 254 + 1 AS varchar), '.', cast(user_id % 254 + 1 AS varchar)) AS ip_address,
  c.latitude, c.longitude, c.country, c.city, event_id
FROM events JOIN (VALUES (0, 'Delhi', 28.6139::double, 77.209::double, 'IN'), (1, 'Mumbai', 19.076::double, 72.8777::double, 'IN'), (2, 'Chennai', 13.0827::double, 80.2707::double, 'IN'), (3, 'Bengaluru', 12.9716::double, 77.5946::double, 'IN'), (4, 'London', 51.5074::double, -0.1278::double, 'GB')) AS c(cid, city, latitude, longitude, country)
  ON c.cid = CASE WHEN event_id % 13 = 0 THEN (user_id + event_id) % 5 ELSE user_id % 4 END
"""

TS = "strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time"

HAVERSINE = (
    "6371.0::double * 2 * atan2(sqrt({a}), sqrt(greatest(1 - ({a}), 0)))"
)


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin((radians({lat2} - {lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2} - {lon1})) / 2), 2))"
    )
    return HAVERSINE.format(a=a)


EXACT = "decimal(28,8)"
# round to the exact binary value, ties to even
R2, R4, R6 = "{:.2f}", "{:.4f}", "{:.6f}"

FEATURES = f"""
h AS (SELECT *, epoch_us(event_time) AS us FROM tx),
raw AS (
  SELECT h.*,
    count(*) OVER p AS n, avg(amount) OVER p AS mu, stddev_pop(amount) OVER p AS sd,
    count(*) OVER w1 AS c1, count(*) OVER w5 AS c5, count(*) OVER w60 AS c60,
    (sum(amount::{EXACT}) OVER w5)::double AS s5, (sum(amount::{EXACT}) OVER w60)::double AS s60,
    count(DISTINCT merchant_id) OVER w60 AS m60,
    arg_max(latitude, us) OVER p AS last_lat, arg_max(longitude, us) OVER p AS last_lon, max(us) OVER p AS last_us
  FROM h
  WINDOW p AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    w1 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 60000000 PRECEDING AND 1 PRECEDING),
    w5 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 300000000 PRECEDING AND 1 PRECEDING),
    w60 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING)
),
feats AS (
  SELECT r.*,
    CASE WHEN sd > 1e-5 THEN (format('{R4}', (amount - mu) / sd)::double + 0.0::double) + 0.0::double ELSE 0.0::double END AS amount_zscore,
    c1::double AS tx_count_1m, c5::double AS tx_count_5m, c60::double AS tx_count_1h,
    (format('{R2}', coalesce(s5, 0.0::double))::double + 0.0::double) AS amount_sum_5m,
    (format('{R2}', CASE WHEN c60 > 0 THEN s60 / c60 ELSE amount END)::double + 0.0::double) AS avg_amount_1h,
    (format('{R4}', CASE WHEN c60 = 0 THEN (CASE WHEN amount > 0 THEN 1.0::double ELSE 1.0::double END)
               WHEN s60 > 0 THEN amount / (s60 / c60) ELSE 1.0::double END)::double + 0.0::double) AS amount_vs_user_avg,
    m60::double AS unique_merchants_1h,
    (n > 0 AND NOT EXISTS (SELECT 1 FROM h g WHERE g.user_id = r.user_id AND g.device_id = r.device_id AND g.us < r.us))::int::double AS new_device,
    (n > 0 AND NOT EXISTS (SELECT 1 FROM h g WHERE g.user_id = r.user_id AND g.city = r.city AND g.us < r.us))::int::double AS new_location,
    coalesce((format('{R2}', {haversine('last_lat', 'last_lon', 'latitude', 'longitude')})::double + 0.0::double), 0.0::double) AS distance_from_last_tx,
    hour(event_time)::double AS hour_of_day, (isodow(event_time) - 1)::double AS day_of_week
  FROM raw r
)"""

FEATURE_LIST = (
    "amount, amount_zscore, tx_count_1m, tx_count_5m, tx_count_1h, amount_sum_5m, avg_amount_1h, "
    "amount_vs_user_avg, unique_merchants_1h, new_device, new_location, distance_from_last_tx, "
    "hour_of_day, day_of_week"
)

ML = "((event_id * 7919) % 1000) / 1000.0::double"


def scored_cte(ml: str, version: str) -> str:
    return f"""
ruled AS (
  SELECT *, {ml} AS ml_anomaly_score, '{version}' AS model_version,
    greatest(0.0::double,
      CASE WHEN tx_count_5m >= 5 THEN 1.0::double WHEN tx_count_5m >= 3 THEN 0.5::double ELSE 0.0::double END,
      CASE WHEN amount_vs_user_avg >= 5 OR amount >= 80000 THEN 1.0::double WHEN amount_vs_user_avg >= 3 OR amount >= 40000 THEN 0.6::double ELSE 0.0::double END,
      CASE WHEN new_device = 1 THEN 0.7::double ELSE 0.0::double END,
      CASE WHEN distance_from_last_tx >= 500 THEN 1.0::double WHEN distance_from_last_tx >= 150 THEN 0.5::double ELSE 0.0::double END,
      CASE WHEN lower(merchant_category) IN ('electronics', 'jewelry', 'crypto_exchange', 'luxury_goods', 'wire_transfer') THEN 0.6::double ELSE 0.0::double END
    ) AS rule_score,
    list_filter([
      CASE WHEN tx_count_5m >= 5 THEN 'High transaction velocity detected (' || tx_count_5m::bigint || ' transactions in 5 minutes)' END,
      CASE WHEN amount_vs_user_avg >= 5 OR amount >= 80000 THEN 'Transaction amount ₹' || format('{{:,.2f}}', amount) || ' is significantly above historical user baseline (' || format('{{:.1f}}', amount_vs_user_avg) || 'x average)' END,
      CASE WHEN new_device = 1 THEN 'Transaction originated from an unrecognized new device' END,
      CASE WHEN distance_from_last_tx >= 500 THEN 'Impossible travel speed / large location shift detected (' || format('{{:.1f}}', distance_from_last_tx) || ' km from prior transaction)' END,
      CASE WHEN lower(merchant_category) IN ('electronics', 'jewelry', 'crypto_exchange', 'luxury_goods', 'wire_transfer') THEN 'Transaction at high-risk merchant category ''' || merchant_category || '''' END
    ], lambda x: x IS NOT NULL) AS rule_reasons,
    least(tx_count_5m / 5.0::double, 1.0::double) AS velocity_score,
    least(least(amount_vs_user_avg, 5.0::double) / 5.0::double * 0.5::double + new_device * 0.25::double + new_location * 0.25::double, 1.0::double) AS behavior_score
  FROM feats
),
blended AS (
  SELECT *, least(greatest(0.35::double * rule_score + 0.35::double * ml_anomaly_score + 0.15::double * velocity_score + 0.15::double * behavior_score, 0.0::double), 1.0::double) AS risk
  FROM ruled
),
banded AS (
  SELECT * EXCLUDE (behavior_score, velocity_score), (format('{R4}', velocity_score)::double + 0.0::double) AS velocity_score, (format('{R4}', behavior_score)::double + 0.0::double) AS behavior_score,
    (format('{R4}', risk)::double + 0.0::double) AS risk_score,
    CASE WHEN risk >= 0.70::double THEN 'HIGH' WHEN risk >= 0.40::double THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM blended
),
scored AS (
  SELECT *, CASE WHEN len(found) > 0 THEN found
      WHEN risk_level <> 'LOW' THEN ['Elevated risk score driven by combined sub-threshold velocity and behavioral signals']
      ELSE ['Normal transaction pattern within expected historical user baseline'] END AS reasons
  FROM (SELECT *, rule_reasons || list_filter([
      CASE WHEN ml_anomaly_score >= 0.65::double THEN 'Unsupervised ML model detected severe statistical anomaly (score: ' || format('{{:.2f}}', ml_anomaly_score) || ')'
           WHEN ml_anomaly_score >= 0.50::double AND risk_level <> 'LOW' THEN 'Elevated ML anomaly signal detected (score: ' || format('{{:.2f}}', ml_anomaly_score) || ')' END
    ], lambda x: x IS NOT NULL) AS found FROM banded)
)"""


def with_features(body: str, tx: str = TX) -> str:
    return f"WITH tx AS ({tx}), {FEATURES.strip()} {body}"


def with_scores(body: str, ml: str = ML, version: str = "supplied_ml_v1") -> str:
    return f"WITH tx AS ({TX}), {FEATURES.strip()}, {scored_cte(ml, version).strip()} {body}"


def with_tx(body: str) -> str:
    return f"WITH tx AS ({TX}) {body}"


HIGH = "count(*) FILTER (WHERE risk_level = 'HIGH')"
MEDIUM = "count(*) FILTER (WHERE risk_level = 'MEDIUM')"
LOW = "count(*) FILTER (WHERE risk_level = 'LOW')"
SPEND = f"(format('{R2}', sum(amount::decimal(28,2))::double)::double + 0.0::double)"
RISK = f"(format('{R6}', sum(risk_score::decimal(28,4))::double / count(*))::double + 0.0::double)"
RATE = f"(format('{R4}', {HIGH}::double / count(*))::double + 0.0::double)"

SCORE_COLUMNS = f"transaction_id, {TS}, user_id, amount, risk_score, risk_level, model_version, rule_score, ml_anomaly_score, velocity_score, behavior_score, array_to_string(reasons, ' | ') AS reasons"

ORACLES: dict[str, str] = {
    # features
    "features_all": with_features(f"SELECT transaction_id, {FEATURE_LIST} FROM feats"),
    "features_all_split_users": with_features(f"SELECT transaction_id, {FEATURE_LIST} FROM feats"),
    "amount_zscore": with_features("SELECT transaction_id, amount, amount_zscore FROM feats"),
    "velocity_counts": with_features("SELECT transaction_id, tx_count_1m, tx_count_5m, tx_count_1h FROM feats"),
    "monetary_windows": with_features(
        "SELECT transaction_id, amount_sum_5m, avg_amount_1h, amount_vs_user_avg FROM feats"
    ),
    "unique_merchants": with_features("SELECT transaction_id, unique_merchants_1h FROM feats"),
    "novelty_flags": with_features("SELECT transaction_id, new_device, new_location FROM feats"),
    "distance_from_last": with_features("SELECT transaction_id, distance_from_last_tx FROM feats"),
    "temporal_features": with_tx(
        "SELECT transaction_id, hour(event_time)::double AS hour_of_day, (isodow(event_time) - 1)::double AS day_of_week FROM tx"
    ),
    "feature_vector": with_features(
        f"SELECT transaction_id, array_to_string(list_transform([{FEATURE_LIST}], lambda x: format('{{:.4f}}', x)), ',') AS feature_vector FROM feats"
    ),
    "haversine": with_tx(
        f"SELECT transaction_id, (format('{R2}', {haversine('28.6139::double', '77.209::double', 'latitude', 'longitude')})::double + 0.0::double) AS km FROM tx"
    ),
    "bounded_window_features": with_tx(
        f""", h AS (SELECT *, epoch_us(event_time) AS us FROM tx)
SELECT transaction_id, (count(*) OVER w1)::double AS tx_count_1m, (count(*) OVER w5)::double AS tx_count_5m, (count(*) OVER w10)::double AS tx_count_1h,
  (format('{R2}', coalesce((sum(amount::{EXACT}) OVER w5)::double, 0.0::double))::double + 0.0::double) AS amount_sum_5m,
  (format('{R2}', CASE WHEN count(*) OVER w10 > 0 THEN (sum(amount::{EXACT}) OVER w10)::double / count(*) OVER w10 ELSE amount END)::double + 0.0::double) AS avg_amount_1h,
  (count(DISTINCT merchant_id) OVER w10)::double AS unique_merchants_1h
FROM h WINDOW w1 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 60000000 PRECEDING AND 1 PRECEDING),
  w5 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 300000000 PRECEDING AND 1 PRECEDING),
  w10 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 600000000 PRECEDING AND 1 PRECEDING)"""
    ),
    # rules and scores
    "rule_scores": with_scores("SELECT transaction_id, rule_score FROM scored"),
    "rule_reasons": with_scores("SELECT transaction_id, array_to_string(rule_reasons, ' | ') AS rule_reasons FROM scored"),
    "hybrid_score": with_scores(
        f"SELECT transaction_id, risk_score, rule_score, (format('{R4}', ml_anomaly_score)::double + 0.0::double) AS ml_score, velocity_score, behavior_score FROM scored"
    ),
    "risk_band_of_tx": with_scores("SELECT transaction_id, risk_level FROM scored"),
    "explanations": with_scores("SELECT transaction_id, array_to_string(reasons, ' | ') AS reasons FROM scored"),
    "scored_with_ml": with_scores(f"SELECT {SCORE_COLUMNS} FROM scored"),
    "scored_rules_only": with_scores(f"SELECT {SCORE_COLUMNS} FROM scored", "0.0::double", "rules_only_v1.0"),
    "fraud_alerts": with_scores(
        f"SELECT concat('alt_', transaction_id) AS alert_id, transaction_id, user_id, amount, {TS}, risk_score, risk_level, array_to_string(reasons, ' | ') AS reasons FROM scored WHERE risk_level = 'HIGH'"
    ),
    # marts
    "mart_daily": with_scores(
        f"SELECT strftime(event_time, '%Y-%m-%d') AS tx_date, count(*) AS total_transactions, {SPEND} AS total_amount, {RISK} AS avg_risk_score, {HIGH} AS high_risk_count, {MEDIUM} AS medium_risk_count, {RATE} AS alert_rate FROM scored GROUP BY 1 ORDER BY 1 DESC"
    ),
    "mart_merchant_category": with_scores(
        f"SELECT merchant_category, count(*) AS total_tx_count, {SPEND} AS total_spend, {RISK} AS avg_merchant_risk_score, {HIGH} AS high_risk_tx_count FROM scored GROUP BY 1 ORDER BY 5 DESC, 4 DESC, 1"
    ),
    "mart_city": with_scores(
        f"SELECT city, count(*) AS total_tx_count, {RISK} AS avg_city_risk_score, {HIGH} AS high_risk_tx_count FROM scored GROUP BY 1 ORDER BY 4 DESC, 3 DESC, 1"
    ),
    "mart_payment_method": with_scores(
        f"SELECT payment_method, count(*) AS total_tx_count, {SPEND} AS total_spend, {HIGH} AS high_risk_tx_count, {RATE} AS alert_rate FROM scored GROUP BY 1 ORDER BY 4 DESC, 1"
    ),
    "mart_top_users": with_scores(
        f"SELECT user_id, count(*) AS user_tx_count, {SPEND} AS total_user_spend, {RISK} AS avg_user_risk_score, {HIGH} AS high_risk_count FROM scored GROUP BY 1 HAVING {HIGH} > 0 ORDER BY 5 DESC, 4 DESC, 1 LIMIT 20"
    ),
    "mart_top_merchants": with_scores(
        f"SELECT merchant_id, count(*) AS total_tx_count, {RISK} AS avg_risk_score, {HIGH} AS high_risk_count FROM scored GROUP BY 1 ORDER BY 4 DESC, 3 DESC, 1 LIMIT 20"
    ),
    "mart_risk_bands": with_scores(
        f"SELECT risk_level, count(*) AS tx_count, (format('{R2}', sum(amount::decimal(28,2))::double / count(*))::double + 0.0::double) AS avg_amount, (format('{R4}', sum(rule_score::decimal(28,4))::double / count(*))::double + 0.0::double) AS avg_rule_score, (format('{R4}', sum(ml_anomaly_score::decimal(28,4))::double / count(*))::double + 0.0::double) AS avg_ml_score FROM scored GROUP BY 1"
    ),
    "summary_metrics": with_scores(
        f"SELECT count(*) AS total_tx_count, {SPEND} AS total_amount, (format('{R4}', sum(risk_score::decimal(28,4))::double / count(*))::double + 0.0::double) AS avg_risk_score, {HIGH} AS high_risk_count, {MEDIUM} AS medium_risk_count, {LOW} AS low_risk_count FROM scored"
    ),
    "daily_rollup": with_scores(
        f"SELECT strftime(event_time, '%Y-%m-%d') AS metric_date, count(*) AS total_transactions, {SPEND} AS total_volume, {HIGH} AS high_risk_count, {MEDIUM} AS medium_risk_count, {LOW} AS low_risk_count, (format('{R4}', sum(risk_score::decimal(28,4))::double / count(*))::double + 0.0::double) AS avg_risk_score, {RATE} AS fraud_alert_rate FROM scored GROUP BY 1"
    ),
    "daily_rollup_snapshot": with_scores(
        f"SELECT '2024-02-01' AS metric_date, count(*) AS total_transactions, {SPEND} AS total_volume, {HIGH} AS high_risk_count, {MEDIUM} AS medium_risk_count, {LOW} AS low_risk_count, (format('{R4}', sum(risk_score::decimal(28,4))::double / count(*))::double + 0.0::double) AS avg_risk_score, {RATE} AS fraud_alert_rate FROM scored"
    ),
    "user_risk_profile": with_scores(
        f"SELECT user_id, count(*) AS tx_count, {SPEND} AS total_amount, {RISK} AS avg_risk_score, max(risk_score) AS max_risk_score, {HIGH} AS high_risk_count, arg_max(risk_level, struct_pack(a := event_time, b := transaction_id)) AS latest_risk_level FROM scored GROUP BY 1"
    ),
}

# --- messages, contract, dedup, warehouse, quality, evaluation, registry ----------------

from tollgate.plans.spoiled import PAYLOAD_SQL  # noqa: E402  (input text, not logic under test)

ALL_TX = "transaction_id, " + TS + ", user_id, account_id, amount, currency, merchant_id, merchant_category, payment_method, device_id, ip_address, latitude, longitude, country, city"

_TEXTS = (
    "transaction_id user_id account_id currency merchant_id merchant_category payment_method device_id ip_address country city"
).split()
_ORDER = (
    "transaction_id event_time user_id account_id amount currency merchant_id merchant_category payment_method "
    "device_id ip_address latitude longitude country city"
).split()


def _checks() -> str:
    parts = []
    for f in _ORDER:
        t, s = f"json_type(j, '$.{f}')", f"json_extract_string(j, '$.{f}')"
        if f not in ("currency", "country"):
            parts.append(f"CASE WHEN {t} IS NULL THEN '{f}: field required' END")
        parts.append(f"CASE WHEN {t} = 'NULL' THEN '{f}: must not be null' END")
        if f in _TEXTS:
            parts.append(f"CASE WHEN {t} NOT IN ('NULL', 'VARCHAR') THEN '{f}: must be a string' END")
        elif f == "event_time":
            parts.append(f"CASE WHEN {t} <> 'NULL' AND try_cast(substr({s}, 1, 26) AS timestamp) IS NULL THEN '{f}: must be an ISO-8601 time' END")
        else:
            parts.append(f"CASE WHEN {t} <> 'NULL' AND try_cast({s} AS double) IS NULL THEN '{f}: must be a finite number' END")
            if f == "amount":
                parts.append(f"CASE WHEN try_cast({s} AS double) < 0 THEN '{f}: must be >= 0' END")
            else:
                b = "90" if f == "latitude" else "180"
                parts.append(f"CASE WHEN try_cast({s} AS double) NOT BETWEEN -{b} AND {b} THEN '{f}: must be within +-{b}' END")
    return ", ".join(parts)


CHECKED = f"""WITH tx AS ({TX}),
msg AS MATERIALIZED (SELECT {PAYLOAD_SQL} AS value, event_id % 6 AS part, event_id AS off
  FROM (SELECT *, event_id % 40 AS k, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS event_text FROM tx)),
js AS MATERIALIZED (SELECT *, CASE WHEN json_valid(value) AND left(value, 1) = '{{' THEN value END AS j FROM msg),
checked AS MATERIALIZED (SELECT *, CASE WHEN j IS NULL THEN ['payload: not a JSON object'] ELSE list_filter([{_checks()}], lambda x: x IS NOT NULL) END AS errors FROM js)
"""


def _jtext(f: str) -> str:
    return f"json_extract_string(j, '$.{f}')"


_VALID = ", ".join(
    {
        "event_time": f"strftime(CASE WHEN {_jtext('event_time')} LIKE '%+05:30' THEN substr({_jtext('event_time')}, 1, 26)::timestamp - INTERVAL 330 MINUTE ELSE substr({_jtext('event_time')}, 1, 26)::timestamp END, '%Y-%m-%d %H:%M:%S.%f')",
        "amount": f"{_jtext('amount')}::double", "latitude": f"{_jtext('latitude')}::double",
        "longitude": f"{_jtext('longitude')}::double",
        "currency": f"coalesce({_jtext('currency')}, 'INR')", "country": f"coalesce({_jtext('country')}, 'IN')",
    }.get(f, _jtext(f))
    + f" AS {f}"
    for f in _ORDER
)

FAULTY = f"""WITH tx AS ({TX}), stg AS (SELECT
  CASE WHEN event_id % 101 = 7 THEN concat('tx_', (event_id - 1)::varchar) ELSE transaction_id END AS transaction_id, event_time,
  CASE WHEN event_id % 89 <> 5 THEN user_id END AS user_id, account_id,
  CASE WHEN event_id % 97 = 3 THEN -amount - 1 ELSE amount END AS amount,
  CASE WHEN event_id % 83 = 2 THEN 'inr' ELSE currency END AS currency,
  CASE WHEN event_id % 79 = 1 THEN '' ELSE merchant_id END AS merchant_id, device_id,
  CASE WHEN event_id % 103 = 9 THEN 91.5::double ELSE latitude END AS latitude, longitude FROM tx)
"""

AUDIT = """, c AS (SELECT count(*) AS total,
  count(*) FILTER (WHERE transaction_id IS NULL OR user_id IS NULL OR account_id IS NULL) AS null_ids,
  count(*) FILTER (WHERE amount < 0) AS negative_amounts,
  count(*) FILTER (WHERE latitude < -90 OR latitude > 90 OR longitude < -180 OR longitude > 180) AS invalid_coordinates,
  (SELECT count(*) FROM (SELECT transaction_id FROM stg GROUP BY 1 HAVING count(*) > 1)) AS duplicate_ids FROM stg),
i AS (SELECT *, list_filter([
  CASE WHEN null_ids > 0 THEN 'Found ' || null_ids || ' transactions with null or empty IDs' END,
  CASE WHEN negative_amounts > 0 THEN 'Found ' || negative_amounts || ' transactions with invalid negative amounts' END,
  CASE WHEN invalid_coordinates > 0 THEN 'Found ' || invalid_coordinates || ' transactions with out-of-bounds lat/lon coordinates' END,
  CASE WHEN duplicate_ids > 0 THEN 'Found ' || duplicate_ids || ' duplicate transaction ID entries' END], lambda x: x IS NOT NULL) AS issues FROM c)
SELECT CASE WHEN len(issues) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, total AS total_records_checked, len(issues) AS issues_count,
  array_to_string(issues, '; ') AS issues, null_ids, negative_amounts, invalid_coordinates, duplicate_ids FROM i"""

PAIRS = f"""WITH tx AS ({TX}), pairs AS (SELECT event_time, {ML} AS score,
  CASE WHEN day(event_time) % 6 = 0 THEN event_id % 3 = 0 ELSE ({ML} >= 0.62::double AND event_id % 7 <> 0) OR event_id % 23 = 0 END AS label FROM tx)
"""


def _counts(t: str) -> str:
    return (
        f"count(*) FILTER (WHERE score < {t} AND NOT label) AS true_negatives, count(*) FILTER (WHERE score >= {t} AND NOT label) AS false_positives, "
        f"count(*) FILTER (WHERE score < {t} AND label) AS false_negatives, count(*) FILTER (WHERE score >= {t} AND label) AS true_positives"
    )


def _rate(num: str, den: str) -> str:
    return f"(format('{R4}', CASE WHEN {den} = 0 THEN 0.0::double ELSE ({num})::double / ({den})::double END)::double)"


RATES = (
    f"{_rate('true_positives', 'true_positives + false_positives')} AS \"precision\", "
    f"{_rate('true_positives', 'true_positives + false_negatives')} AS recall, "
    f"{_rate('2 * true_positives', '2 * true_positives + false_positives + false_negatives')} AS f1_score, "
    f"{_rate('false_positives', 'false_positives + true_negatives')} AS false_positive_rate"
)

AUC = f"""(SELECT format('{R4}', CASE WHEN p = 0 OR n = 0 THEN 0.5::double ELSE (ranks - p * (p + 1) / 2.0::double) / (p::double * n) END)::double FROM (
  SELECT sum(CASE WHEN label THEN r ELSE 0 END) AS ranks, count(*) FILTER (WHERE label) AS p, count(*) FILTER (WHERE NOT label) AS n FROM (
    SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::double AS r FROM pairs)))"""

SWEEP = f""", grid AS (SELECT 0.35::double + i * (0.5::double / 49) AS threshold FROM range(50) g(i)),
swept AS (SELECT threshold, {_counts('threshold')} FROM pairs, grid GROUP BY 1), rated AS (SELECT *, {RATES} FROM swept)
"""

RUNS = f"""{PAIRS}, daily AS (SELECT event_time::date AS day, {_counts('0.55::double')} FROM pairs GROUP BY 1),
runs AS (SELECT 'iforest_' || strftime(day, '%Y%m%d') AS model_version, day, *, {RATES} FROM daily),
stat AS (SELECT *, CASE WHEN f1_score >= 0.5 THEN 'APPROVED' ELSE 'CANDIDATE' END AS status FROM runs)
"""

ORACLES |= {
    "parse_json_events": with_tx(f"SELECT {ALL_TX} FROM tx"),
    "validate_events": f"{CHECKED} SELECT {_VALID} FROM checked WHERE len(errors) = 0",
    "dead_letters": f"{CHECKED} SELECT value AS raw_payload, array_to_string(errors, '; ') AS error_message, split_part(errors[1], ': ', 1) AS error_type, 'transactions.raw' AS source_topic, part::int AS partition, off AS \"offset\" FROM checked WHERE len(errors) > 0",
    "strip_labels": with_tx(f"SELECT {ALL_TX} FROM tx"),
    "publish_projection": with_tx(f"SELECT user_id AS key, transaction_id, {TS}, city FROM tx"),
    "ops_counters": with_scores(
        f", seen AS ({CHECKED} SELECT count(*) AS c, count(*) FILTER (WHERE len(errors) > 0) AS f FROM checked) "
        "SELECT 'events_consumed' AS metric, c AS total FROM seen UNION ALL SELECT 'events_failed', f FROM seen "
        "UNION ALL SELECT 'risk_predictions_' || lower(risk_level), count(*) FROM scored GROUP BY 1"
    ),
    "avg_last_1000": with_tx(
        f"SELECT format('{R4}', sum(amount::decimal(28,2))::double / count(*))::double AS avg_last_1000 FROM (SELECT amount FROM tx ORDER BY event_time DESC, event_id DESC LIMIT 1000)"
    ),
    "dedup_last_wins": with_tx(
        ", copies AS (SELECT *, event_id AS seq FROM tx UNION ALL SELECT * REPLACE (amount + 1 AS amount), event_id + 1000000000000 FROM tx WHERE event_id % 10 = 0) "
        "SELECT transaction_id, amount, seq FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY seq DESC) AS rn FROM copies) WHERE rn = 1"
    ),
    "warehouse_load_staging": with_tx(
        f"SELECT transaction_id, {TS}, user_id, merchant_category, city, (CASE WHEN event_id % 10 = 0 THEN amount + 1 ELSE amount END)::decimal(15,2)::double AS amount, latitude::decimal(9,6)::double AS latitude, longitude::decimal(9,6)::double AS longitude FROM tx"
    ),
    "warehouse_load_scores": with_scores(
        f"SELECT transaction_id, {TS}, user_id, risk_level, model_version, to_json(reasons)::varchar AS reasons_json, amount::decimal(15,2)::double AS amount, risk_score, rule_score, ml_anomaly_score FROM scored"
    ),
    "warehouse_load_alerts": with_scores(
        "SELECT concat('alt_', transaction_id) AS alert_id, transaction_id, user_id, risk_score, risk_level FROM scored WHERE risk_level = 'HIGH'"
    ),
    "backfill_range": with_scores(
        f"SELECT {SCORE_COLUMNS} FROM scored WHERE event_time >= '2024-01-10' AND event_time < '2024-01-13'", "0.0::double", "rules_only_v1.0"
    ),
    "dq_audit": FAULTY + AUDIT,
    "dq_audit_clean": f"WITH stg AS ({TX})" + AUDIT,
    "dq_duplicates": FAULTY + "SELECT transaction_id, count(*) AS copies FROM stg GROUP BY 1 HAVING count(*) > 1",
    "dq_extended": FAULTY + """SELECT count(*) FILTER (WHERE trim(transaction_id) = '' OR trim(user_id) = '' OR trim(account_id) = '') AS empty_ids,
  count(*) FILTER (WHERE NOT regexp_matches(currency, '^[A-Z]{3}$')) AS bad_currency, count(*) FILTER (WHERE merchant_id IS NULL OR trim(merchant_id) = '') AS bad_merchant,
  count(*) FILTER (WHERE device_id IS NULL OR trim(device_id) = '') AS bad_device, count(*) FILTER (WHERE event_time IS NULL OR event_time > '2024-01-30') AS bad_event_time FROM stg""",
    "confusion_matrix": f"{PAIRS} SELECT {_counts('0.55::double')} FROM pairs",
    "eval_metrics": f"{PAIRS}, c AS (SELECT {_counts('0.55::double')}, count(*) AS total_samples, count(*) FILTER (WHERE label) AS positive_count FROM pairs) SELECT *, {RATES}, 0.55::double AS threshold, {AUC} AS roc_auc FROM c",
    "roc_auc": f"{PAIRS} SELECT {AUC} AS roc_auc",
    "threshold_sweep": f"{PAIRS}{SWEEP} SELECT * REPLACE (format('{R6}', threshold)::double AS threshold) FROM rated",
    "best_threshold": f"{PAIRS}{SWEEP} SELECT format('{R6}', threshold)::double AS threshold, f1_score, \"precision\", recall FROM rated ORDER BY f1_score DESC, rated.threshold LIMIT 1",
    "score_percentiles": with_scores(
        f"SELECT format('{R6}', quantile_cont(risk_score, 0.5))::double AS p50, format('{R6}', quantile_cont(risk_score, 0.95))::double AS p95, format('{R6}', quantile_cont(risk_score, 0.99))::double AS p99 FROM scored"
    ),
    "normalize_score": with_tx(
        f"SELECT transaction_id, format('{R4}', least(greatest(0.5::double - ((event_id % 1300) / 1000.0::double - 0.6::double), 0), 1))::double AS anomaly_score FROM tx"
    ),
    "latest_approved_model": f"{RUNS} SELECT model_version, f1_score, status FROM stat WHERE status = 'APPROVED' ORDER BY day DESC LIMIT 1",
    "model_gate": f"""{RUNS}, prev AS (SELECT s.model_version, s.f1_score, coalesce((SELECT p.f1_score FROM stat p WHERE p.status = 'APPROVED' AND p.day < s.day ORDER BY p.day DESC LIMIT 1), 0.0::double) AS previous_f1 FROM stat s)
SELECT model_version, f1_score AS candidate_f1, previous_f1, CASE WHEN f1_score >= 0.5::double AND f1_score >= previous_f1 - 0.05::double THEN 'APPROVED' ELSE 'REJECTED' END AS final_status FROM prev""",
    "model_registry_status": f"{RUNS} SELECT model_version, greatest(f1_score, 0.6::double) AS f1_score, CASE WHEN model_version = 'iforest_20240105' THEN 'RETIRED' ELSE status END AS status FROM stat",
    "warehouse_daily_metrics": ORACLES["daily_rollup"],
}

# --- detectors, drift -------------------------------------------------------------------

WHO = f"transaction_id, user_id, {TS}, amount"

_ESCALATION = with_tx(
    f""", s AS (SELECT *, epoch_us(event_time) AS us, lag(amount, 1) OVER w AS a1, lag(amount, 2) OVER w AS a2, lag(epoch_us(event_time), 1) OVER w AS t1, lag(epoch_us(event_time), 2) OVER w AS t2
  FROM tx WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id))
SELECT {WHO}, a1 AS previous_amount, a2 AS amount_before_that FROM s WHERE amount > a1 AND a1 > a2 AND us - t1 <= 120000000 AND t1 - t2 <= 120000000"""
)
_SESSIONS = with_tx(
    f""", g AS (SELECT *, epoch_us(event_time) AS us, epoch_us(event_time) - lag(epoch_us(event_time)) OVER w AS gap FROM tx WINDOW w AS (PARTITION BY user_id ORDER BY event_time)),
s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 60000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_time) AS sid FROM g)
SELECT user_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(max(event_time), '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS tx_count,
  format('{R2}', sum(amount::{EXACT})::double)::double AS total_amount FROM s GROUP BY user_id, sid HAVING count(*) >= 2"""
)
_KMH = "(distance_from_last_tx / ((us - last_us) / 1000000.0::double / 3600.0::double))"

_BANDS = "(CASE WHEN amount >= 80000 THEN 6 WHEN amount >= 40000 THEN 5 WHEN amount >= 20000 THEN 4 WHEN amount >= 10000 THEN 3 WHEN amount >= 5000 THEN 2 WHEN amount >= 1000 THEN 1 ELSE 0 END)"

ORACLES |= {
    "detect_velocity_escalation": _ESCALATION,
    "detect_velocity_escalation_split_users": _ESCALATION,
    "detect_amount_spike": with_features(
        f"SELECT {WHO}, amount_vs_user_avg, amount_zscore FROM feats WHERE amount >= 40000 AND (amount_vs_user_avg >= 3 OR amount_zscore >= 3)"
    ),
    "detect_impossible_travel": with_features(
        f"SELECT {WHO}, distance_from_last_tx AS km, format('{{:.1f}}', {_KMH})::double AS kmh FROM feats WHERE n > 0 AND {_KMH} > 900"
    ),
    "detect_new_device_high_value": with_features(
        f"SELECT {WHO}, device_id FROM feats WHERE new_device = 1 AND amount >= 20000"
    ),
    "detect_merchant_shift": with_tx(
        f"""SELECT {WHO}, merchant_category FROM tx a WHERE merchant_category IN ('electronics', 'jewelry', 'crypto_exchange', 'luxury_goods', 'wire_transfer')
  AND EXISTS (SELECT 1 FROM tx b WHERE b.user_id = a.user_id AND b.event_time < a.event_time)
  AND NOT EXISTS (SELECT 1 FROM tx b WHERE b.user_id = a.user_id AND b.merchant_category = a.merchant_category AND b.event_time < a.event_time)"""
    ),
    "detect_burst": with_tx(
        f""", s AS (SELECT *, epoch_us(event_time) AS us FROM tx WHERE amount < 20000), c AS (SELECT *, 1 + count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 300000000 PRECEDING AND 1 PRECEDING) AS payments_in_span FROM s)
SELECT {WHO}, payments_in_span FROM c WHERE payments_in_span >= 4"""
    ),
    "burst_sessions": _SESSIONS,
    "burst_sessions_split_users": _SESSIONS,
    "mart_combined_rule": with_features(
        "SELECT transaction_id, amount, tx_count_5m FROM feats WHERE new_device = 1 AND amount >= 20000 AND tx_count_5m >= 1"
    ),
    "alert_precision_by_band": with_scores(
        f""", l AS (SELECT *, CASE WHEN day(event_time) % 6 = 0 THEN event_id % 3 = 0 ELSE ({ML} >= 0.62::double AND event_id % 7 <> 0) OR event_id % 23 = 0 END AS is_fraud FROM scored)
SELECT risk_level, count(*) AS tx_count, count(*) FILTER (WHERE is_fraud) AS fraud_count, format('{R4}', (count(*) FILTER (WHERE is_fraud))::double / count(*))::double AS fraud_rate FROM l GROUP BY 1"""
    ),
    "drift_report": with_scores(
        f""", p AS (SELECT event_time < '2024-01-16' AS ref, *, {_BANDS} AS band FROM scored),
m AS (SELECT ref, count(*)::double AS volume, sum(amount::{EXACT})::double / count(*) AS mean_amount, sum(risk_score::{EXACT})::double / count(*) AS mean_risk_score,
  sum(tx_count_5m::{EXACT})::double / count(*) AS mean_tx_count_5m, sum(new_device::{EXACT})::double / count(*) AS new_device_rate, {HIGH}::double / count(*) AS alert_rate FROM p GROUP BY 1),
u AS (UNPIVOT m ON volume, mean_amount, mean_risk_score, mean_tx_count_5m, new_device_rate, alert_rate INTO NAME metric VALUE v),
sh AS (SELECT b.band, greatest(count(*) FILTER (WHERE p.ref AND p.band = b.band), 0.5::double) / count(*) FILTER (WHERE p.ref) AS r,
  greatest(count(*) FILTER (WHERE NOT p.ref AND p.band = b.band), 0.5::double) / count(*) FILTER (WHERE NOT p.ref) AS c FROM p, range(7) b(band) GROUP BY 1)
SELECT a.metric, format('{R4}', a.v)::double AS reference, format('{R4}', b.v)::double AS current, format('{R4}', b.v / a.v - 1)::double + 0.0::double AS shift FROM u a JOIN u b USING (metric) WHERE a.ref AND NOT b.ref
UNION ALL SELECT 'amount_psi', 0.0::double, 0.0::double, format('{R4}', sum((c - r) * ln(c / r)))::double FROM sh"""
    ),
}

# --- streams ----------------------------------------------------------------------------


def sliding(label: str, duration: int, slide: int, every: bool = False) -> str:
    """Windows that the watermark has closed (end <= newest time - 10 minutes), or every one."""
    d, s = duration * 1_000_000, slide * 1_000_000
    return with_tx(
        f""", w AS (SELECT *, epoch_us(event_time) AS us FROM tx),
g AS (SELECT user_id, (us // {s}) * {s} - k * {s} AS st, amount, merchant_id FROM w, range({duration // slide}) r(k)),
m AS (SELECT max(us) // 1000 * 1000 - 600000000 AS wm FROM w)
SELECT user_id, strftime(make_timestamp(st), '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(make_timestamp(st + {d}), '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  count(*) AS tx_count_{label}, max(amount) AS max_amount_{label}, count(DISTINCT merchant_id) AS unique_merchants_{label},
  format('{R2}', sum(amount::{EXACT})::double)::double AS amount_sum_{label}, format('{R2}', sum(amount::{EXACT})::double / count(*))::double AS avg_amount_{label}
FROM g, m WHERE {every} OR st + {d} <= wm GROUP BY user_id, st"""
    )


_VALID_TX = f"{CHECKED} SELECT {_VALID.replace('strftime(CASE', '(CASE').replace(chr(39) + '%Y-%m-%d %H:%M:%S.%f' + chr(39) + ')', ')').replace('END, )', 'END)')} FROM checked WHERE len(errors) = 0"

ORACLES |= {
    "stream_sliding_5m": sliding("5m", 300, 60),
    "stream_sliding_1m": sliding("1m", 60, 10),
    "stream_sliding_1h": sliding("1h", 3600, 300),
    "stream_dedup": with_tx("SELECT transaction_id, user_id, amount FROM tx"),
    "stream_features": ORACLES["features_all"],
    # what streams after the day in the middle, seen against everything before
    "stream_features_seeded": with_features(
        f"SELECT transaction_id, {FEATURE_LIST} FROM feats WHERE epoch_us(event_time) >= (SELECT (min(epoch_us(event_time)) + max(epoch_us(event_time))) // 2 // 86400000000 * 86400000000 FROM tx)"
    ),
    "stream_dead_letters": f"{CHECKED} SELECT value AS raw_payload, array_to_string(errors, '; ') AS error_message, split_part(errors[1], ': ', 1) AS error_type, 'transactions.raw' AS source_topic FROM checked WHERE len(errors) > 0",
    "stream_to_warehouse": f"WITH tx AS MATERIALIZED ({_VALID_TX}), {FEATURES.strip()}, {scored_cte('0.0::double', 'rules_only_v1.0').strip()} SELECT transaction_id, user_id, risk_level, model_version, risk_score, rule_score FROM scored",
    "late_events": with_tx(
        f""", s AS (SELECT *, max(epoch_us(event_time)) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000000 AS wm FROM tx)
SELECT transaction_id, user_id, format('{R4}', (wm - epoch_us(event_time)) / 1e6::double)::double AS seconds_late FROM s WHERE epoch_us(event_time) < wm"""
    ),
}

ORACLES["stream_counters"] = f"""{CHECKED} SELECT 'events_consumed' AS metric, count(*) AS total FROM checked
UNION ALL SELECT 'events_failed' AS metric, count(*) FILTER (WHERE len(errors) > 0) AS total FROM checked
UNION ALL SELECT 'risk_predictions_' || lower(risk_level) AS metric, count(*) AS total FROM ({ORACLES["stream_to_warehouse"]}) GROUP BY risk_level"""

# arrival in four slices by event id; a valid event is late if it lies below the watermark of the slices before its own
ORACLES["stream_late_events"] = f"""{CHECKED},
valid AS ({_VALID_TX[len(CHECKED):]}),
placed AS (SELECT event_time, cast(substr(transaction_id, 4) AS bigint) AS event_id, cast(substr(transaction_id, 4) AS bigint) * 4 // ((SELECT max(event_id) FROM events) + 1) AS slice FROM valid),
marks AS (SELECT slice, date_trunc('milliseconds', max(max(event_time)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - INTERVAL 10 MINUTE AS watermark FROM placed GROUP BY slice)
SELECT event_id, CASE WHEN event_time < watermark THEN 'late' ELSE 'scored' END AS outcome FROM placed JOIN marks USING (slice)
UNION ALL SELECT cast(off AS bigint) AS event_id, 'dead' AS outcome FROM checked WHERE len(errors) > 0"""

# the last windows too, which an append stream never emits on finite input
ORACLES |= {
    "sliding_5m_all": sliding("5m", 300, 60, every=True),
    "sliding_1m_all": sliding("1m", 60, 10, every=True),
    "sliding_1h_all": sliding("1h", 3600, 300, every=True),
}
