"""Operators on small hand-made frames."""

import json
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import alerts as al
from ledgerwatch.operators import analytics as an
from ledgerwatch.operators import percentiles as pc
from ledgerwatch.operators import quality as qu
from ledgerwatch.operators import windows as wi
from ledgerwatch.sources.messages import alert_messages, decode_alerts, parse_transactions, quarantine
from ledgerwatch.sources.tables import read_alerts, write_alerts, write_report

ALERT = """alert_id string, transaction_id string, account_id string, merchant_category string, amount double,
    country string, fraud_score double, label string, rules_triggered array<string>, detection_latency_ms double,
    at string, is_fraud_ground_truth boolean"""


def alert_frame(spark, rows):
    """Rows of (transaction, account, label, score, latency, time, rules, truth)."""
    values = [
        (f"id-{t}", t, account, "RETAIL", 10.0, "US", score, label, rules, latency, at, truth)
        for t, account, label, score, latency, at, rules, truth in rows
    ]
    frame = spark.createDataFrame(values, ALERT)
    return frame.withColumn("detected_at", F.col("at").cast("timestamp")).drop("at")


@pytest.fixture(scope="module")
def alerts(spark):
    return alert_frame(
        spark,
        [
            ("T1", "A", "FRAUD", 0.91, 10.0, "2024-01-01 00:00:01", ["HIGH_RISK_MCC:GAMBLING", "X"], True),
            ("T2", "A", "REVIEW", 0.70, 30.0, "2024-01-01 00:00:02", ["HIGH_RISK_MCC:CRYPTO_EXCHANGE"], False),
            ("T3", "B", "REVIEW", 1.00, 20.0, "2024-01-01 00:00:17", ["X"], True),
        ],
    )


def test_histogram_closes_the_last_bin(alerts):
    rows = {r.bin: r.alerts for r in an.score_histogram(alerts).collect()}
    assert rows == {k: int(k in (14, 18, 19)) for k in range(20)}


def test_time_bins_without_alerts_count_zero(alerts):
    rows = an.alerts_over_time(alerts).orderBy("bin_start").collect()
    assert [r.alerts for r in rows] == [2, 0, 0, 1]


def test_time_bins_over_several_days(spark):
    days = alert_frame(
        spark,
        [
            ("T1", "A", "FRAUD", 0.9, 1.0, "1969-12-30 23:59:58", [], True),
            ("T2", "A", "FRAUD", 0.9, 1.0, "1970-01-02 00:00:03", [], True),
        ],
    )
    bins = an.alerts_over_time(days)
    assert bins.count() == 2 * 86400 // 5 + 2
    assert bins.agg(F.sum("alerts")).first()[0] == 2


def test_rules_are_counted_by_name(alerts):
    assert [tuple(r) for r in an.rule_frequency(alerts).collect()] == [("HIGH_RISK_MCC", 2), ("X", 2)]


def test_no_alerts_give_zero_totals(alerts):
    none = alerts.where("false")
    assert tuple(al.global_stats(none).first()) == (0, 0.0)
    assert an.alert_kpis(none).first().fraud_pct == 0.0
    assert an.alerts_over_time(none).isEmpty()
    assert pc.nearest_rank(none, "detection_latency_ms", pc.NEAREST_RANK, 2).first().p50 is None


def test_history_keeps_the_newest_of_accounts_with_a_recent_alert(spark):
    rows = [(f"T{i}", "A", "FRAUD", 0.9, 1.0, f"2024-01-01 00:00:{i:02d}", [], True) for i in range(5)]
    rows.append(("T9", "OLD", "FRAUD", 0.9, 1.0, "2023-12-30 00:00:00", [], True))
    kept = al.account_history(alert_frame(spark, rows), F.lit("2024-01-01 12:00:00").cast("timestamp"), keep=2)
    assert [(r.transaction_id, r.position) for r in kept.orderBy("position").collect()] == [("T4", 1), ("T3", 2)]


def test_alerts_survive_the_message_format(alerts):
    sent = alert_messages(alerts)
    broken = sent.selectExpr("key", "substring(value, 1, 40) as value")
    back = decode_alerts(sent.union(broken))
    assert back.count() == 3
    assert back.exceptAll(alerts.select(back.columns)).isEmpty()
    assert set(json.loads(sent.first().value)) == set(back.columns)


def test_alert_table_is_pruned_by_day(spark, alerts, tmp_path):
    path = str(tmp_path / "alerts")
    write_alerts(alerts, path)
    day = read_alerts(spark, path).where("alert_date = date'2024-01-01'")
    assert day.count() == 3
    assert "PartitionFilters: [isnotnull(alert_date" in day._jdf.queryExecution().toString()
    # Another day is added, the same day is replaced.
    write_alerts(alerts.withColumn("detected_at", F.expr("detected_at + interval 1 day")), path)
    write_alerts(alerts, path)
    assert {r.alert_date.day: r["count"] for r in read_alerts(spark, path).groupBy("alert_date").count().collect()} == {1: 3, 2: 3}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 1000])
def test_percentiles_equal_brute_force(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.lognormal(3, 2, n), 2)
    values[rng.random(n) < 0.33] = 7.25
    if n > 5:
        values[0], values[1] = -3.5, 0.0
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    ordered = sorted(values)
    exact = pc.nearest_rank(frame, "v", pc.NEAREST_RANK, 2).first()
    for name, p in pc.NEAREST_RANK.items():
        assert exact[name] == ordered[min(int(n * p / 100), n - 1)]
    between = pc.interpolated(frame, "v", pc.INTERPOLATED, 6).first()
    for name, p in pc.INTERPOLATED.items():
        assert between[name] == pytest.approx(np.quantile(values, p), abs=1e-6)
    assert between["mean"] == pytest.approx(values.mean(), abs=1e-6)


def test_percentile_sketch_is_close(spark):
    frame = spark.range(10_000).selectExpr("cast(id as double) as v")
    assert pc.approximate_percentiles(frame, "v", {"p50": 0.5}).first().p50 == pytest.approx(5000, abs=10)


def test_report_counts_all_probes(spark, alerts, tmp_path):
    probes = spark.createDataFrame(
        [("T1", True), ("T2", False), ("T4", True), ("T5", False), ("T6", False)],
        "transaction_id string, is_fraud boolean",
    ).withColumn("sent_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    report = qu.classifier_report(probes, alerts)
    row = report.first()
    assert (row.true_positives, row.false_positives, row.true_negatives, row.false_negatives) == (1, 1, 2, 1)
    assert (row.precision, row.recall, row.f1_score, row.coverage_pct) == (0.5, 0.5, 0.5, 40.0)
    write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().f1_score == 0.5
    latencies = qu.probe_latency(probes, alerts)
    summary = qu.latency_summary(latencies).first()
    assert summary.latency_mean_ms == 1500.0
    assert summary.latency_stdev_ms == round(statistics.stdev([1000.0, 2000.0]), 2)
    assert qu.latency_summary(latencies.limit(1)).first().latency_stdev_ms == 0.0


def test_report_without_detections_divides_by_one(spark, alerts):
    probes = spark.createDataFrame([("T7", False)], "transaction_id string, is_fraud boolean").withColumn(
        "sent_at", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    row = qu.classifier_report(probes, alerts).first()
    assert (row.precision, row.recall, row.f1_score) == (0.0, 0.0, 0.0)


def test_quarantine_reasons(spark):
    good = {"transaction_id": "T", "account_id": "A", "amount": 1.5, "timestamp": "2024-01-01T00:00:00+00:00"}
    cases = [
        (json.dumps(good), None),
        (json.dumps(good)[:30], "no transaction_id"),
        ("", "no transaction_id"),
        (json.dumps({**good, "account_id": None}), "no account_id"),
        (json.dumps({**good, "amount": None}), "no amount"),
        (json.dumps({**good, "amount": 1e300}), "amount out of range"),
        (json.dumps({**good, "timestamp": "yesterday"}), "no event time"),
        (json.dumps({**good, "timestamp": "2024-01-01T00:00:00.123456Z", "extra": 1}), None),
    ]
    raw = spark.createDataFrame([(str(i), body) for i, (body, _) in enumerate(cases)], "key string, value string")
    raw = raw.selectExpr("cast(key as binary) as key", "cast(value as binary) as value", "current_timestamp() as timestamp")
    reasons = {int(r.account_key): r.reason for r in quarantine(raw).collect()}
    assert reasons == {i: reason for i, (_, reason) in enumerate(cases) if reason}
    assert parse_transactions(raw).count() == sum(reason is None for _, reason in cases)


def test_session_ends_only_after_more_than_the_gap(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 00:10:00.000001"]
    rows = spark.createDataFrame([("A", 1.25, t) for t in times], "account_id string, amount double, at string")
    sessions = wi.account_sessions(rows.withColumn("event_time", F.col("at").cast("timestamp")))
    assert [(r.session_count, r.session_spend) for r in sessions.orderBy("session_start").collect()] == [(2, 2.5), (1, 1.25)]


def test_windows_do_not_count_missing_merchants(spark):
    rows = spark.createDataFrame(
        [("A", m, c, 1.0, t) for m, c, t in [("M1", "US", "00:00:10"), (None, "US", "00:01:10"), ("M1", None, "00:06:10")]],
        "account_id string, merchant_id string, country string, amount double, at string",
    ).selectExpr("account_id", "merchant_id", "country", "amount", "cast(concat('2024-01-01 ', at) as timestamp) as event_time")
    windows = wi.window_activity(rows).orderBy("window_start").collect()
    assert [(w.window_txn_count, w.window_distinct_merchants, w.window_distinct_countries) for w in windows] == [
        (1, 1, 1), (2, 1, 1), (2, 1, 1), (2, 1, 1), (2, 1, 1), (1, 0, 1), (1, 1, 0), (1, 1, 0), (1, 1, 0), (1, 1, 0), (1, 1, 0)
    ][: len(windows)]
