"""Amounts and values of any size, rows from the future, repeated alerts."""

import json
import os
import time
from decimal import Decimal

import numpy as np
import pytest

from ledgerwatch.functions.columns import rounded
from ledgerwatch.operators import quality
from ledgerwatch.operators.percentiles import interpolated, nearest_rank
from ledgerwatch.operators.velocity import session_velocity, trailing_velocity
from ledgerwatch.operators.windows import window_activity
from ledgerwatch.sources.messages import STREAM_FAULT, parse_transactions, quarantine
from ledgerwatch.streaming.sessions import session_after


def rows(spark, amounts):
    table = spark.createDataFrame([(f"T{i:05}", float(a)) for i, a in enumerate(amounts)], "transaction_id string, amount double")
    return table.selectExpr(
        "transaction_id", "'A' as account_id", "'M' as merchant_id", "'US' as country", "amount",
        "cast(timestamp_micros(1704067200000000 + 1000 * cast(substring(transaction_id, 2) as bigint)) as timestamp_ntz) as event_time",
    )


@pytest.mark.parametrize("amounts", [[9.9e12] * 1000, [1e15] * 3, [0.00004] * 100, [1e19, 0.01]])
def test_sums_of_large_and_small_amounts(spark, amounts):
    table = rows(spark, amounts)
    expected = pytest.approx(sum(amounts), rel=1e-14)
    for found in (session_velocity(table), trailing_velocity(table)):
        assert found.agg({"window_spend": "max"}).first()[0] == expected
    assert window_activity(table).agg({"window_total_spend": "max"}).first()[0] == expected


def test_means_of_small_values(spark):
    values = spark.createDataFrame([(1e-5,), (2e-5,), (3e-5,)], "v double")
    assert interpolated(values, "v", {"p50": 0.5}, 6).first().asDict() == {"p50": 2e-5, "mean": 2e-5}


def test_nan_comes_last_and_small_values_have_buckets(spark):
    values = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),)], "v double")
    assert nearest_rank(values, "v", {"p50": 50.0}, 2).first().p50 == 3.0
    signed = spark.createDataFrame([(x,) for x in (-2.0, -1e-9, 0.0, 1e-300, 1e-9, float("inf"))], "v double")
    found = nearest_rank(signed, "v", {"a": 0.0, "b": 20.0, "c": 40.0, "d": 60.0, "e": 70.0, "f": 99.0}, 12).first()
    assert list(found) == [-2.0, -1e-9, 0.0, 0.0, 1e-9, float("inf")]


def test_rounding_of_any_double(spark):
    values = spark.createDataFrame([(1.005,), (1e300,), (-2.5e17,)], "v double")
    assert [r[0] for r in values.selectExpr(rounded("v", 2)).collect()] == [1.01, 1e300, -2.5e17]


def message(spark, *times):
    body = {"transaction_id": "T", "account_id": "A", "amount": 1.0}
    raw = [(str(i).encode(), json.dumps({**body, "timestamp": t}).encode(), "2024-01-01 01:00:00") for i, t in enumerate(times)]
    return spark.createDataFrame(raw, "key binary, value binary, at string").selectExpr("key", "value", "cast(at as timestamp) as timestamp")


def test_rows_from_the_future_are_set_aside_with_their_message(spark):
    raw = message(spark, "2024-01-01T01:04:59+00:00", "2030-01-01T00:00:00+00:00")
    assert parse_transactions(raw).count() == 2
    (bad,) = quarantine(raw, STREAM_FAULT).collect()
    assert bad.reason == "event time in the future" and json.loads(bad.message)["timestamp"].startswith("2030")


def test_state_is_kept_per_account_whatever_the_others_bring(spark, tmp_path):
    """Three batches: ten accounts; one row just ahead and one far ahead; the accounts again, a late row among them."""
    from ledgerwatch.sources.streams import file_messages
    from ledgerwatch.streaming.scoring import ScoringJob, start_scoring

    def body(transaction, account, time):
        fields = {"amount": 1.5, "timestamp": f"{time}+00:00", "transaction_id": transaction, "account_id": account}
        return account.encode(), json.dumps(fields).encode()

    first = [body(f"T{i}", f"A{i}", "2024-01-01T01:00:00") for i in range(10)]
    ahead = [body("U", "B", "2024-01-01T01:04:59"), body("V", "A0", "2030-01-01T00:00:00"), (b"", b"\xff{"), (b"", None)]
    again = [body(f"W{i}", f"A{i}", "2024-01-01T01:02:00") for i in range(9)]
    again += [body("W9", "A9", "2024-01-01T01:05:00.000001"), body("X", "B", "2024-01-01T01:01:00")]
    (tmp_path / "in").mkdir()
    for k, (raw, sent) in enumerate([(first, "01:00"), (ahead, "01:00"), (again, "01:02")]):
        name = f"{tmp_path}/in/part-{k}.parquet"
        frame = spark.createDataFrame(raw, "key binary, value binary").selectExpr("*", f"timestamp'2024-01-01 {sent}:00' as timestamp")
        frame.toPandas().to_parquet(name, index=False, coerce_timestamps="us")
        os.utime(name, (time.time() - 100 + k, time.time() - 100 + k))
    job = ScoringJob(str(tmp_path / "out"))
    start_scoring(file_messages(spark, str(tmp_path / "in")), job, str(tmp_path / "cp"), available_now=True).awaitTermination()
    scored = {r.transaction_id: (r.window_count, r.window_spend) for r in spark.read.parquet(job.output + "/scored").collect()}
    assert {scored[f"W{i}"] for i in range(9)} == {(2, 3.0)}
    assert (scored["W9"], scored["U"], scored["X"]) == ((1, 1.5), (1, 1.5), (2, 3.0))
    assert "V" not in scored and len(scored) == 10 + 1 + 11
    reasons = [r.reason for r in spark.read.parquet(job.output + "/quarantine").collect()]
    assert sorted(reasons) == ["event time in the future", "no transaction_id", "no transaction_id"]


def test_sessions_are_exact():
    gap, start = 300_000_000, 1_704_067_200_000_000
    large = Decimal(10) ** 23
    steps = [(0, large), (0, Decimal("0.0001")), (gap, Decimal(1)), (gap - 1, Decimal(2)), (2 * gap + 1, Decimal(3))]
    session, found = None, []
    for after, units in steps:
        session = session_after(session, np.array([start + after]), [units])
        found.append(session[:2])
    total = large + Decimal("0.0001")
    assert found == [(1, large), (2, total), (3, total + 1), (4, total + 3), (1, Decimal(3))]
    assert session[2] == start + 2 * gap + 1


def test_repeated_alerts_count_once(spark):
    probes = spark.createDataFrame(
        [(f"T{i}", i < 2) for i in range(3)], "transaction_id string, is_fraud boolean"
    ).selectExpr("*", "timestamp'2024-01-01 00:00:00' as sent_at")
    alerts = spark.createDataFrame([("T0", 1), ("T0", 9), ("T2", 3)], "transaction_id string, s int").selectExpr(
        "transaction_id", "'FRAUD' as label", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, s) as detected_at"
    )
    report = quality.full_report(probes, alerts).first()
    assert (report.probes_sent, report.alerts_received, report.true_positives, report.false_positives) == (3, 2, 1, 1)
    assert (report.latency_mean_ms, report.latency_p50_ms) == (2000.0, 3000.0)
    assert quality.probe_latency(probes, alerts).count() == 2
