"""The SQL that each registered query is checked against.

The SQL states the meaning in the plainest way (whole-account windows, naive joins) and
shares no shortcut with the Spark operators.
"""

from __future__ import annotations

EVENTS_AS_TRANSACTIONS = """
base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 300) AS event_time,
    ['US','GB','DE','BR','NG','RO','CN','PK','VN','FR'][(event_id // 12) % 10 + 1] AS country
  FROM events),
txn AS (
  SELECT event_id,
    'TXN' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS transaction_id,
    'ACC' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS account_id,
    'MER' || lpad(CAST(event_id % 200 + 1 AS VARCHAR), 5, '0') AS merchant_id,
    CAST(CAST(CASE WHEN k % 10 = 0 THEN floor(value) * 100 WHEN k % 10 = 1 THEN value * 20 ELSE value END
      AS DECIMAL(18,2)) AS DOUBLE) AS amount,
    'USD' AS currency,
    CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'PURCHASE' WHEN 'click' THEN 'TRANSFER'
      WHEN 'view' THEN 'WITHDRAWAL' WHEN 'error' THEN 'REFUND' END AS transaction_type,
    ['GROCERY','ELECTRONICS','TRAVEL','RESTAURANT','FUEL','PHARMACY','ENTERTAINMENT','GAMBLING',
     'CRYPTO_EXCHANGE','MONEY_TRANSFER','ATM','RETAIL'][event_id % 12 + 1] AS merchant_category,
    country,
    country || '-CITY' AS city,
    ['mobile_ios','mobile_android','desktop_chrome','desktop_safari','api_key','unknown']
      [(event_id // 120) % 6 + 1] AS device_type,
    '10.0.' || CAST((event_id // 250) % 250 AS VARCHAR) || '.' || CAST(event_id % 250 AS VARCHAR) AS ip_address,
    strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
    k < 2 AS is_fraud,
    event_time,
    value AS latency_ms
  FROM base)"""

FEATURES = (
    EVENTS_AS_TRANSACTIONS
    + """,
pauses AS (
  SELECT *, CASE WHEN epoch_us(event_time) - lag(epoch_us(event_time)) OVER w > 300000000 THEN 1 ELSE 0 END AS pause
  FROM txn WINDOW w AS (PARTITION BY account_id ORDER BY event_time, transaction_id)),
sessions AS (
  SELECT *, sum(pause) OVER (PARTITION BY account_id ORDER BY event_time, transaction_id
    ROWS UNBOUNDED PRECEDING) AS session_no FROM pauses),
feat AS (
  SELECT *, count(*) OVER w AS window_count,
    CAST(sum(CAST(amount AS DECIMAL(18,4))) OVER w AS DOUBLE) AS window_spend
  FROM sessions WINDOW w AS (PARTITION BY account_id, session_no ORDER BY event_time, transaction_id
    ROWS UNBOUNDED PRECEDING))"""
)

# Rule name -> (predicate, weight, text)
RULES = {
    "HIGH_AMOUNT_3K": ("amount >= 3000", "0.3", "'HIGH_AMOUNT_3K'"),
    "VERY_HIGH_AMOUNT_8K": ("amount >= 8000", "0.2", "'VERY_HIGH_AMOUNT_8K'"),
    "HIGH_RISK_MCC": (
        "merchant_category IN ('GAMBLING','CRYPTO_EXCHANGE','MONEY_TRANSFER')",
        "0.25",
        "'HIGH_RISK_MCC:' || merchant_category",
    ),
    "HIGH_RISK_COUNTRY": ("country IN ('NG','RO','CN','PK','VN')", "0.2", "'HIGH_RISK_COUNTRY:' || country"),
    "UNKNOWN_DEVICE": ("device_type = 'unknown'", "0.1", "'UNKNOWN_DEVICE'"),
    "MICRO_AMOUNT_CARD_TEST": ("amount > 0 AND amount < 2", "0.15", "'MICRO_AMOUNT_CARD_TEST'"),
    "SUSPICIOUSLY_ROUND_AMOUNT": ("amount % 100 = 0 AND amount >= 500", "0.08", "'SUSPICIOUSLY_ROUND_AMOUNT'"),
}

RULE_SCORE = (
    "least("
    + " + ".join(
        f"CASE WHEN {p} THEN CAST({w} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END" for p, w, _ in RULES.values()
    )
    + ", CAST(1 AS DOUBLE))"
)
RULE_TEXTS = ", ".join(f"CASE WHEN {p} THEN {t} END" for p, _, t in RULES.values())
VELOCITY_SCORE = """(CASE WHEN window_count > 20
    THEN least((window_count - 20) / CAST(30 AS DOUBLE), CAST(0.4 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN window_spend > 5000
    THEN least((window_spend - 5000) / CAST(10000 AS DOUBLE), CAST(0.3 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END)"""
VELOCITY_TEXTS = """CASE WHEN window_count > 20 THEN 'VELOCITY_COUNT:' || CAST(window_count AS VARCHAR) END,
  CASE WHEN window_spend > 5000 THEN 'VELOCITY_SPEND:' || CAST(CAST(round_even(window_spend, 0) AS BIGINT) AS VARCHAR) END"""

SCORED = (
    FEATURES
    + f""",
parts AS (
  SELECT *, {RULE_SCORE} AS rule_score, {VELOCITY_SCORE} AS velocity_score,
    concat_ws('|', {RULE_TEXTS}, {VELOCITY_TEXTS}) AS rules_triggered
  FROM feat),
scored AS (SELECT *, least(rule_score + velocity_score, CAST(1 AS DOUBLE)) AS fraud_score FROM parts)"""
)


def _round(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(30,12)), {places}) AS DOUBLE)"


ALERTS = (
    SCORED
    + f""",
alerts AS (
  SELECT sha256(transaction_id) AS alert_id, transaction_id, account_id, merchant_category, amount, country,
    {_round('fraud_score', 4)} AS fraud_score,
    CASE WHEN fraud_score >= CAST(0.8 AS DOUBLE) THEN 'FRAUD' ELSE 'REVIEW' END AS label,
    rules_triggered, latency_ms AS detection_latency_ms,
    event_time + to_microseconds(CAST(round(latency_ms * 1000) AS BIGINT)) AS detected_at,
    is_fraud AS is_fraud_ground_truth
  FROM scored WHERE fraud_score >= CAST(0.65 AS DOUBLE))"""
)

ALERT_RULES = """rule_rows AS (
  SELECT split_part(unnest(string_split(rules_triggered, '|')), ':', 1) AS rule, is_fraud_ground_truth FROM alerts)"""

PROBES = (
    ALERTS
    + """,
outcomes AS (
  SELECT t.transaction_id, t.is_fraud, a.label, a.label IS NOT NULL AS alerted,
    coalesce(a.label IN ('FRAUD','REVIEW'), false) AS detected,
    (epoch_us(a.detected_at) - epoch_us(t.event_time)) / CAST(1000 AS DOUBLE) AS latency_ms
  FROM txn t LEFT JOIN alerts a ON a.transaction_id = t.transaction_id)"""
)


TRAILING_SUMS = (
    "count(*) OVER w AS window_count, CAST(sum(CAST(amount AS DECIMAL(18,4))) OVER w AS DOUBLE) AS window_spend"
)


def _trailing(measures: str) -> str:
    return (
        EVENTS_AS_TRANSACTIONS
        + f""",
trail AS (
  SELECT *, {measures} FROM txn WINDOW w AS (PARTITION BY account_id ORDER BY event_time
    RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW))"""
    )


def _windows(starts: str) -> str:
    return (
        EVENTS_AS_TRANSACTIONS
        + f""",
spread AS (SELECT *, unnest({starts}) AS window_start FROM txn)
SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, account_id,
  count(*) AS window_txn_count,
  CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS window_total_spend,
  count(DISTINCT merchant_id) AS window_distinct_merchants,
  count(DISTINCT country) AS window_distinct_countries,
  max(amount) AS window_max_amount,
  {_round('CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) / count(*)', 6)} AS window_avg_amount
FROM spread GROUP BY window_start, account_id"""
    )


def _top(column: str) -> str:
    return f"SELECT {column}, count(*) AS alerts FROM alerts GROUP BY 1 ORDER BY alerts DESC, {column} LIMIT 8"


def _buckets(source: str, column: str, bounds: list[str], places: int) -> str:
    parts = [
        f"SELECT '{b}' AS le, count(*) FILTER (WHERE {column} <= CAST({b} AS DOUBLE)) AS cumulative FROM {source}"
        for b in bounds
    ]
    parts.append(f"SELECT '+Inf' AS le, count(*) AS cumulative FROM {source}")
    total = f"(SELECT CAST(round(sum(CAST({column} AS DECIMAL(30,12))), {places}) AS DOUBLE) FROM {source})"
    return (
        "SELECT le, cumulative, "
        + total
        + f" AS value_sum, (SELECT count(*) FROM {source}) AS value_count FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


def _nearest_rank(p: str) -> str:
    return f"[least(CAST(floor(n * CAST({p} AS DOUBLE) / 100) AS BIGINT), n - 1) + 1]"


def _rule_query(name: str) -> str:
    predicate, weight, text = RULES[name]
    return _with(
        EVENTS_AS_TRANSACTIONS,
        f"SELECT transaction_id, account_id, amount, {text} AS rule, CAST({weight} AS DOUBLE) AS weight "
        f"FROM txn WHERE {predicate}",
    )


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


TRANSACTION_COLUMNS = """transaction_id, account_id, merchant_id, amount, currency, transaction_type,
  merchant_category, country, city, device_type, ip_address, "timestamp", is_fraud"""

FIVE_SLIDES = "[date_trunc('minute', event_time) - to_minutes(CAST(i AS INTEGER)) FOR i IN range(5)]"
TUMBLING = "[time_bucket(INTERVAL 5 MINUTES, event_time)]"

CONFUSION = """count(*) FILTER (WHERE is_fraud AND detected) AS true_positives,
  count(*) FILTER (WHERE NOT is_fraud AND detected) AS false_positives,
  count(*) FILTER (WHERE NOT is_fraud AND NOT detected) AS true_negatives,
  count(*) FILTER (WHERE is_fraud AND NOT detected) AS false_negatives"""
COVERAGE = f"""count(*) AS probes_sent, count(*) FILTER (WHERE alerted) AS alerts_received,
  {_round('count(*) FILTER (WHERE alerted) * 100 / CAST(count(*) AS DOUBLE)', 1)} AS coverage_pct"""


# The same detector report, with the latency of the probes that raised an alert.
REPORT = f""",
counts AS (SELECT {COVERAGE}, {CONFUSION},
  {_round('avg(latency_ms) FILTER (WHERE alerted)', 2)} AS latency_mean_ms,
  {_round('coalesce(stddev_samp(latency_ms) FILTER (WHERE alerted), 0)', 2)} AS latency_stdev_ms FROM outcomes),
rates AS (SELECT *,
  {_round('true_positives / CAST(greatest(true_positives + false_positives, 1) AS DOUBLE)', 4)} AS "precision",
  {_round('true_positives / CAST(greatest(true_positives + false_negatives, 1) AS DOUBLE)', 4)} AS recall FROM counts),
sorted AS (SELECT list(latency_ms ORDER BY latency_ms) AS l, count(*) AS n FROM outcomes WHERE alerted)"""
FULL_REPORT = (
    "SELECT rates.*, "
    + _round('CAST(2 AS DOUBLE) * "precision" * recall / greatest("precision" + recall, CAST(0.0001 AS DOUBLE))', 4)
    + " AS f1_score, "
    + ", ".join(
        f"{_round('l' + _nearest_rank(p), 2)} AS latency_{name}_ms"
        for name, p in (("p50", "50"), ("p90", "90"), ("p99", "99"), ("p999", "99.9"))
    )
    + " FROM rates, sorted"
)

# A third of the rows on one account, a fifth of them at the start of their five minutes: ties, and pauses of exactly the gap.
SKEWED = """
skewed AS (SELECT * REPLACE (
    CASE WHEN event_id % 3 = 0 THEN 'ACC000000' ELSE account_id END AS account_id,
    make_timestamp(epoch_us(event_time) // 300000000 * 300000000
      + CASE WHEN event_id % 5 = 0 THEN 0 ELSE epoch_us(event_time) % 300000000 END) AS event_time) FROM txn),
pauses AS"""
SKEWED_FEATURES = FEATURES.replace("\npauses AS", SKEWED, 1).replace("FROM txn WINDOW", "FROM skewed WINDOW")

# A third of the rows on one account and in four microseconds.
TIED = """
skewed AS (SELECT * REPLACE (
    CASE WHEN event_id % 3 = 0 THEN 'ACC000000' ELSE account_id END AS account_id,
    CASE WHEN event_id % 3 = 0
      THEN make_timestamp(1704070800000000 + [0, 300000000, 600000001, 900000000][greatest(1, event_id % 8 - 3)])
      ELSE event_time END AS event_time) FROM txn)"""
TIED_FEATURES = SKEWED_FEATURES.replace(SKEWED, TIED + ",\npauses AS", 1)


def oracle_sql() -> dict[str, str]:
    mean = "CAST(sum(CAST({0} AS DECIMAL(18,4))) AS DOUBLE) / count({0})"
    return {
        "parse_transactions": _with(
            EVENTS_AS_TRANSACTIONS,
            f"SELECT event_time AS kafka_timestamp, {TRANSACTION_COLUMNS}, event_time FROM txn WHERE event_id % 97 <> 0",
        ),
        "quarantined_messages": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT account_id AS account_key, event_time AS kafka_timestamp, 'no transaction_id' AS reason "
            "FROM txn WHERE event_id % 97 = 0",
        ),
        "rule_high_amount": _rule_query("HIGH_AMOUNT_3K"),
        "rule_very_high_amount": _rule_query("VERY_HIGH_AMOUNT_8K"),
        "rule_high_risk_mcc": _rule_query("HIGH_RISK_MCC"),
        "rule_high_risk_country": _rule_query("HIGH_RISK_COUNTRY"),
        "rule_unknown_device": _rule_query("UNKNOWN_DEVICE"),
        "rule_micro_amount": _rule_query("MICRO_AMOUNT_CARD_TEST"),
        "rule_round_amount": _rule_query("SUSPICIOUSLY_ROUND_AMOUNT"),
        "rule_scores": _with(
            EVENTS_AS_TRANSACTIONS, f"SELECT transaction_id, account_id, {RULE_SCORE} AS rule_score FROM txn"
        ),
        "rules_triggered": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT transaction_id, account_id, "
            + " + ".join(f"CAST({p} AS BIGINT)" for p, _, _ in ((f"({q})", w, t) for q, w, t in RULES.values()))
            + f" AS rule_count, concat_ws('|', {RULE_TEXTS}) AS rules_triggered FROM txn",
        ),
        "scalar_functions": _with(
            EVENTS_AS_TRANSACTIONS,
            f"""SELECT transaction_id, account_id AS text_of_bytes, country AS json_field, event_time AS parsed_time,
  least(amount, CAST(100 AS DOUBLE)) AS at_most, greatest(amount, CAST(100 AS DOUBLE)) AS at_least,
  amount % 100 = 0 AS is_round,
  merchant_category IN ('GAMBLING','CRYPTO_EXCHANGE','MONEY_TRANSFER') AS is_member,
  merchant_category || ':' || country AS tagged, merchant_category AS head,
  CAST(round_even(amount, 0) AS BIGINT) AS whole_amount,
  {_round('amount / 7', 4)} AS rounded,
  merchant_category || ', ' || country || ', ' || device_type AS first_words,
  left("timestamp", 19) AS first_chars,
  '$' || format('{{:,.2f}}', amount) AS money,
  CASE WHEN amount > 100 THEN amount ELSE CAST(0 AS DOUBLE) END AS or_zero,
  CAST(round(latency_ms * 1000) AS BIGINT) AS apart_us
FROM txn""",
        ),
        "velocity_features": _with(
            FEATURES, "SELECT transaction_id, account_id, event_time, amount, window_count, window_spend FROM feat"
        ),
        "velocity_trailing": _with(
            _trailing(TRAILING_SUMS),
            "SELECT transaction_id, account_id, event_time, amount, window_count, window_spend FROM trail",
        ),
        "velocity_windows": "WITH " + _windows(FIVE_SLIDES),
        "velocity_windows_approx": "WITH exact AS (WITH " + _windows(FIVE_SLIDES) + ")"
        "SELECT window_start, account_id, window_txn_count, true AS same_count, window_distinct_merchants, "
        "window_distinct_countries, true AS window_distinct_merchants_near, true AS window_distinct_countries_near "
        "FROM exact",
        "velocity_tumbling": "WITH " + _windows(TUMBLING),
        "skewed_velocity": _with(
            SKEWED_FEATURES, "SELECT transaction_id, account_id, event_time, amount, window_count, window_spend FROM feat"
        ),
        "heavy_accounts": _with(
            ALERTS,
            "SELECT account_id, count(*) AS n FROM alerts GROUP BY 1 "
            "HAVING count(*) >= CAST(0.01 AS DOUBLE) * (SELECT count(*) FROM alerts)",
        ),
        "heavy_merchants": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT merchant_id, count(*) AS n FROM txn GROUP BY 1 "
            "HAVING count(*) >= CAST(0.005 AS DOUBLE) * (SELECT count(*) FROM txn)",
        ),
        "heavy_categories": _with(
            ALERTS,
            "SELECT merchant_category, count(*) AS n FROM alerts GROUP BY 1 "
            "HAVING count(*) >= CAST(0.05 AS DOUBLE) * (SELECT count(*) FROM alerts)",
        ),
        "quantile_errors": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT unnest(['p50', 'p75', 'p90', 'p95', 'p99']) AS metric, n, true AS near "
            "FROM (SELECT count(*) AS n FROM txn)",
        ),
        "tied_velocity": _with(
            TIED_FEATURES, "SELECT transaction_id, account_id, event_time, amount, window_count, window_spend FROM feat"
        ),
        "tied_trailing": _with(
            _trailing(TRAILING_SUMS).replace(",\ntrail AS", f",{TIED},\ntrail AS").replace("FROM txn WINDOW", "FROM skewed WINDOW"),
            "SELECT transaction_id, account_id, event_time, amount, window_count, window_spend FROM trail",
        ),
        "full_report": _with(PROBES + REPORT, FULL_REPORT),
        "repeated_alerts": _with(PROBES + REPORT, FULL_REPORT),
        "account_sessions": _with(
            FEATURES,
            "SELECT account_id, min(event_time) AS session_start, max(event_time) AS session_last, "
            "count(*) AS session_count, CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS session_spend "
            "FROM feat GROUP BY account_id, session_no",
        ),
        "account_features": _with(
            FEATURES
            + """,
newest AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY event_time DESC, transaction_id DESC) AS r,
  max(epoch_us(event_time)) OVER () - epoch_us(event_time) <= 300000000 AS still_open FROM feat)""",
            "SELECT account_id, CASE WHEN still_open THEN window_count ELSE 0 END AS window_count, "
            "CASE WHEN still_open THEN window_spend ELSE CAST(0 AS DOUBLE) END AS window_spend "
            "FROM newest WHERE r = 1",
        ),
        "velocity_scores": _with(
            SCORED, "SELECT transaction_id, account_id, window_count, window_spend, velocity_score FROM scored"
        ),
        "scored_transactions": _with(
            SCORED,
            "SELECT transaction_id, account_id, event_time, amount, window_count, window_spend, rule_score, "
            "velocity_score, fraud_score, rules_triggered FROM scored",
        ),
        "alerts": _with(ALERTS, "SELECT * FROM alerts"),
        "alert_messages": _with(
            ALERTS,
            "SELECT account_id AS key, * REPLACE "
            "(strftime(detected_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS detected_at) FROM alerts",
        ),
        "account_alert_history": _with(
            ALERTS
            + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY detected_at DESC, transaction_id) AS position,
  max(detected_at) OVER (PARTITION BY account_id) AS last_alert FROM alerts)""",
            "SELECT account_id, position, transaction_id, fraud_score, label, detected_at FROM ranked "
            "WHERE position <= 100 AND last_alert > (SELECT max(event_time) FROM txn) - INTERVAL 24 HOURS",
        ),
        "live_feed": _with(ALERTS, "SELECT * FROM alerts ORDER BY detected_at DESC, transaction_id LIMIT 500"),
        "live_alerts": _with(ALERTS, "SELECT * FROM alerts ORDER BY detected_at DESC, transaction_id LIMIT 200"),
        "feed_rows": _with(
            ALERTS,
            """SELECT transaction_id, label, format('{:.3f}', fraud_score) AS score,
  '$' || format('{:,.2f}', amount) AS amount, account_id, merchant_category || ' / ' || country AS place,
  CAST(round_even(detection_latency_ms, 0) AS BIGINT) AS latency_ms,
  array_to_string(string_split(rules_triggered, '|')[1:3], ', ') AS rules,
  left(strftime(detected_at, '%Y-%m-%dT%H:%M:%S.%f'), 19) AS detected
FROM (SELECT * FROM alerts ORDER BY detected_at DESC, transaction_id LIMIT 25)""",
        ),
        "global_stats": _with(
            ALERTS,
            "SELECT count(*) AS total_alerts, "
            "CAST(coalesce(sum(CAST(amount AS DECIMAL(18,4))), 0) AS DOUBLE) AS total_amount_flagged FROM alerts",
        ),
        "alert_kpis": _with(
            ALERTS,
            f"""SELECT count(*) AS alerts, count(*) FILTER (WHERE label = 'FRAUD') AS fraud_alerts,
  count(*) FILTER (WHERE label = 'REVIEW') AS review_alerts,
  {_round("count(*) FILTER (WHERE label = 'FRAUD') * 100 / CAST(count(*) AS DOUBLE)", 1)} AS fraud_pct,
  {_round("count(*) FILTER (WHERE label = 'REVIEW') * 100 / CAST(count(*) AS DOUBLE)", 1)} AS review_pct,
  {_round(mean.format('fraud_score'), 3)} AS avg_score,
  {_round(mean.format('detection_latency_ms'), 2)} AS avg_latency_ms FROM alerts""",
        ),
        "score_histogram": _with(
            ALERTS,
            "SELECT CAST(b.bin AS INTEGER) AS bin, b.bin / CAST(20 AS DOUBLE) AS bin_start, "
            "count(fraud_score) AS alerts FROM range(20) b(bin) "
            "LEFT JOIN alerts ON least(floor(fraud_score * 20), 19) = b.bin GROUP BY 1, 2",
        ),
        "score_buckets": _with(
            SCORED,
            _buckets(
                "scored", "fraud_score", ["0.1", "0.2", "0.3", "0.4", "0.5", "0.6", "0.7", "0.8", "0.9", "1"], 4
            ),
        ),
        "latency_buckets": _with(
            EVENTS_AS_TRANSACTIONS,
            _buckets("txn", "latency_ms", ["5", "10", "25", "50", "100", "250", "500", "1000", "2500"], 2),
        ),
        "pipeline_counters": _with(
            SCORED,
            "SELECT count(*) AS transactions_processed, "
            "count(*) FILTER (WHERE fraud_score >= CAST(0.65 AS DOUBLE)) AS alerts_emitted FROM scored",
        ),
        "throughput": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT count(*) AS transactions, "
            + _round(
                "count(*) / greatest((epoch_us(max(event_time)) - epoch_us(min(event_time))) / CAST(1000000 AS DOUBLE), "
                "CAST(0.001 AS DOUBLE))",
                4,
            )
            + " AS per_second FROM txn",
        ),
        "throughput_per_second": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT date_trunc('second', event_time) AS second, count(*) AS transactions FROM txn GROUP BY 1",
        ),
        "alerts_per_5s": _with(
            ALERTS
            + """,
counted AS (SELECT time_bucket(INTERVAL 5 SECONDS, detected_at) AS bin_start, count(*) AS n FROM alerts GROUP BY 1),
bins AS (SELECT unnest(generate_series((SELECT min(bin_start) FROM counted), (SELECT max(bin_start) FROM counted),
  INTERVAL 5 SECONDS)) AS bin_start)""",
            "SELECT bin_start, coalesce(n, 0) AS alerts FROM bins LEFT JOIN counted USING (bin_start)",
        ),
        "top_categories": _with(ALERTS, _top("merchant_category")),
        "top_countries": _with(ALERTS, _top("country")),
        "top_accounts": _with(ALERTS, _top("account_id")),
        "rule_frequency": _with(
            ALERTS + ",\n" + ALERT_RULES,
            "SELECT rule, count(*) AS alerts FROM rule_rows GROUP BY 1 ORDER BY alerts DESC, rule LIMIT 10",
        ),
        "latency_percentiles": _with(
            ALERTS,
            " UNION ALL ".join(
                f"SELECT 'p{p}' AS metric, {_round(f'quantile_cont(detection_latency_ms, 0.{p})', 1)} AS latency_ms "
                "FROM alerts"
                for p in (50, 75, 90, 95, 99)
            )
            + f" UNION ALL SELECT 'mean', {_round(mean.format('detection_latency_ms'), 1)} FROM alerts",
        ),
        "probe_latency": _with(
            PROBES,
            f"SELECT transaction_id, label, is_fraud, {_round('latency_ms', 3)} AS latency_ms "
            "FROM outcomes WHERE alerted",
        ),
        "probe_coverage": _with(PROBES, f"SELECT {COVERAGE} FROM outcomes"),
        "confusion_matrix": _with(PROBES, f"SELECT {CONFUSION} FROM outcomes"),
        "classifier_report": _with(
            PROBES
            + f""",
counts AS (SELECT {COVERAGE}, {CONFUSION} FROM outcomes),
rates AS (SELECT *,
  {_round('true_positives / CAST(greatest(true_positives + false_positives, 1) AS DOUBLE)', 4)} AS "precision",
  {_round('true_positives / CAST(greatest(true_positives + false_negatives, 1) AS DOUBLE)', 4)} AS recall FROM counts)""",
            "SELECT *, "
            + _round(
                'CAST(2 AS DOUBLE) * "precision" * recall / greatest("precision" + recall, CAST(0.0001 AS DOUBLE))', 4
            )
            + " AS f1_score FROM rates",
        ),
        "latency_nearest_rank": _with(
            PROBES
            + """,
sorted AS (SELECT list(latency_ms ORDER BY latency_ms) AS l, count(*) AS n FROM outcomes WHERE alerted)""",
            "SELECT "
            + ", ".join(
                f"{_round('l' + _nearest_rank(p), 2)} AS {name}"
                for name, p in (("p50", "50"), ("p90", "90"), ("p99", "99"), ("p999", "99.9"))
            )
            + " FROM sorted",
        ),
        "latency_summary": _with(
            PROBES,
            f"SELECT count(*) AS n, {_round('avg(latency_ms)', 2)} AS latency_mean_ms, "
            f"{_round('coalesce(stddev_samp(latency_ms), 0)', 2)} AS latency_stdev_ms FROM outcomes WHERE alerted",
        ),
        "geo_impossible": _with(
            EVENTS_AS_TRANSACTIONS
            + """,
steps AS (SELECT *, lag(country) OVER w AS previous_country, lag(event_time) OVER w AS previous_time
  FROM txn WINDOW w AS (PARTITION BY account_id ORDER BY event_time, transaction_id))""",
            "SELECT transaction_id, account_id, event_time, country, previous_country, "
            "(epoch_us(event_time) - epoch_us(previous_time)) / CAST(1000000 AS DOUBLE) AS seconds_apart FROM steps "
            "WHERE previous_country <> country AND event_time - previous_time < INTERVAL 30 MINUTES",
        ),
        "card_testing": _with(
            _trailing("count(*) FILTER (WHERE amount > 0 AND amount < 2) OVER w AS micro_count"),
            "SELECT transaction_id, account_id, event_time, amount, micro_count FROM trail "
            "WHERE amount >= 3000 AND micro_count >= 1",
        ),
        "night_owl": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT transaction_id, account_id, event_time, amount FROM txn "
            "WHERE hour(event_time) IN (2, 3) AND amount >= 200",
        ),
        "velocity_abuse": _with(
            FEATURES,
            "SELECT transaction_id, account_id, event_time, window_count FROM feat WHERE window_count > 20",
        ),
        "spend_anomaly": _with(
            _trailing(
                "count(*) OVER w AS trailing_count, "
                "CAST(sum(CAST(amount AS DECIMAL(18,4))) OVER w AS DOUBLE) / count(*) OVER w AS trailing_avg"
            ),
            "SELECT transaction_id, account_id, event_time, amount, trailing_count, trailing_avg FROM trail "
            "WHERE trailing_count >= 5 AND amount > 3 * trailing_avg",
        ),
        "device_switching": _with(
            EVENTS_AS_TRANSACTIONS,
            "SELECT time_bucket(INTERVAL 5 MINUTES, event_time) AS window_start, account_id, "
            "count(DISTINCT device_type) AS devices FROM txn GROUP BY 1, 2 HAVING count(DISTINCT device_type) >= 3",
        ),
        "rule_precision": _with(
            ALERTS + ",\n" + ALERT_RULES,
            "SELECT rule, count(*) AS alerts, count(*) FILTER (WHERE is_fraud_ground_truth) AS true_fraud, "
            + _round("count(*) FILTER (WHERE is_fraud_ground_truth) / CAST(count(*) AS DOUBLE)", 4)
            + ' AS "precision" FROM rule_rows GROUP BY 1',
        ),
    }
