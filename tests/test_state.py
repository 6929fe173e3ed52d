"""What streams keep as state, read back and compared with the batch operators."""

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions.scores import score_transactions
from ledgerwatch.operators import alerts as al
from ledgerwatch.operators import detectors
from ledgerwatch.operators.velocity import GAP_US, open_sessions, session_velocity
from ledgerwatch.operators.windows import account_features
from ledgerwatch.plans import catalog
from ledgerwatch.sources import events
from ledgerwatch.sources.messages import parse_transactions
from ledgerwatch.sources.streams import file_messages
from ledgerwatch.streaming import detectors as detecting
from ledgerwatch.streaming.history import kept_history, start_history
from ledgerwatch.streaming.lifecycle import ProgressTable
from ledgerwatch.streaming.scoring import ScoringJob, start_scoring
from ledgerwatch.streaming.sessions import live_features, session_after
from ledgerwatch.streaming.velocity import start_table
from tests.compare import assert_same
from tests.test_streaming import write_in_order


def test_session_after_any_batches():
    """However an account's rows are cut into batches, the session at the end is the same, exactly."""
    draw = np.random.default_rng(3)
    for _ in range(200):
        us = np.cumsum(draw.choice([0, 1, GAP_US, GAP_US + 1, 5], 30)) + 1_704_067_200_000_000
        units = np.array([Decimal(10) ** int(k) + Decimal("0.0001") for k in draw.integers(0, 21, 30)], object)
        began = max([0, *(np.flatnonzero(np.diff(us) > GAP_US) + 1)])
        expected = (30 - began, sum(int(u * 10**4) for u in units[began:]), int(us[-1]))
        cuts = [0, *sorted(draw.integers(1, 30, 4)), 30]
        session = None
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                session = session_after(session, us[a:b], units[a:b])
        assert (session[0], int(session[1] * 10**4), session[2]) == expected


def test_row_older_than_the_open_session_counts_in_it(spark):
    late = session_after((3, Decimal(5), 10 * GAP_US), np.array([GAP_US, 10 * GAP_US + 1]), [Decimal(1), Decimal(2)])
    assert late == (5, Decimal(8), 10 * GAP_US + 1)
    rows = spark.createDataFrame(
        [("T1", "A", 10.0, "2024-01-01 00:00:00"), ("T2", "A", 20.0, "2024-01-01 00:08:00")],
        "transaction_id string, account_id string, amount double, at string",
    ).selectExpr("transaction_id", "account_id", "amount", "cast(at as timestamp) as event_time")
    last = "unix_micros(timestamp'2024-01-01 00:09:00')"
    earlier = spark.range(1).selectExpr(
        "'A' as account_id", "3L as carried_n", "cast(50000 as decimal(38,4)) as carried_units", f"{last} as carried_last_us"
    )
    counted = session_velocity(rows, earlier=earlier).orderBy("transaction_id").collect()
    assert [(r.window_count, r.window_spend) for r in counted] == [(4, 15.0), (5, 35.0)]


@pytest.fixture(scope="module")
def halves(spark, small, tmp_path_factory):
    """The transactions before some time as a table, and the later ones as message files."""
    folder = tmp_path_factory.mktemp("later")
    middle = "timestamp'2024-01-01 01:00:00'"
    messages = events.messages(spark, small)
    write_in_order(messages.where(f"timestamp >= {middle}"), str(folder), "timestamp", files=3)
    return parse_transactions(messages.where(f"timestamp < {middle}")), parse_transactions(messages), str(folder)


@pytest.fixture(scope="module")
def continued(spark, halves, tmp_path_factory):
    """A scoring stream that was started from the sessions of a scored table."""
    first, _, folder = halves
    paths = [str(tmp_path_factory.mktemp(name)) for name in ("out", "checkpoint")]
    earlier = open_sessions(score_transactions(session_velocity(first)))
    query = start_scoring(file_messages(spark, folder), ScoringJob(paths[0]), paths[1], available_now=True, earlier=earlier)
    query.awaitTermination()
    return paths


def test_stream_goes_on_with_the_sessions_of_a_table(spark, halves, continued):
    first, whole, _ = halves
    columns = ["transaction_id", "window_count", "window_spend", "fraud_score"]
    late = whole.join(first.select("transaction_id"), "transaction_id", "left_anti").select("transaction_id")
    expected = score_transactions(session_velocity(whole)).join(late, "transaction_id").select(*columns)
    streamed = spark.read.parquet(f"{continued[0]}/scored").select(*columns)
    own = score_transactions(session_velocity(whole.join(late, "transaction_id"))).select(*columns)
    assert_same(streamed.toPandas(), expected.toPandas())
    assert streamed.exceptAll(own).count() > 0  # the table mattered


def test_live_features_are_those_of_the_rows(spark, halves, continued):
    assert_same(live_features(spark, continued[1]).toPandas(), account_features(halves[1]).toPandas())


def test_history_of_a_stream_equals_batch_after_a_restart(spark, small, tmp_path):
    alerts = catalog._alerts(spark, small).withColumn("detected_at", F.expr("cast(detected_at as timestamp)"))
    for name in ("in", "more"):
        (tmp_path / name).mkdir()
    write_in_order(alerts, str(tmp_path / "in"), "detected_at", files=4)
    schema = alerts.schema

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        start_history(stream, str(tmp_path / "cp"), available_now=True).awaitTermination()

    run()
    # Later on some alerts come once more, and new ones that end the history of accounts without any.
    again = alerts.limit(20)
    new = alerts.where("account_id in ('ACC000001', 'ACC000002')").selectExpr(
        *[
            {"detected_at": "detected_at + interval 30 hours as detected_at", "transaction_id": "concat('N', transaction_id) as transaction_id"}.get(c, c)
            for c in alerts.columns
        ]
    )
    again.unionByName(new).write.parquet(str(tmp_path / "more/part"))
    import glob
    import shutil

    for k, part in enumerate(sorted(glob.glob(str(tmp_path / "more/part/*.parquet")))):
        shutil.copy(part, tmp_path / f"in/more-{k}.parquet")
    run()
    both = alerts.unionByName(new)
    now = both.agg(F.max("detected_at")).scalar()
    columns = ["account_id", "position", "transaction_id", "fraud_score", "label", "detected_at"]
    expected = al.account_history(both, now).selectExpr("*").withColumn("position", F.expr("cast(position as bigint)")).select(*columns)
    found = kept_history(spark, str(tmp_path / "cp"))
    assert 0 < found.select("account_id").distinct().count() <= 2
    assert_same(found.toPandas(), expected.toPandas())


# Detectors


@pytest.fixture(scope="module")
def in_order(spark, small, tmp_path_factory):
    """Transactions as files in order of time, with a row at the end that closes all windows."""
    folder = str(tmp_path_factory.mktemp("in_order"))
    rows = events.transactions(spark, small).withColumn("event_time", F.expr("cast(event_time as timestamp)"))
    rows = rows.withColumn("country", F.expr("if(hash(transaction_id) % 10 = 0, null, country)"))
    rows = rows.withColumn("amount", F.expr("if(hash(transaction_id) % 6 = 0, 1.5D, if(hash(transaction_id) % 6 = 1, 5000D, amount))"))
    rows = rows.withColumn("device_type", F.expr("concat('D', pmod(hash(transaction_id), 5))"))
    end = rows.limit(1).withColumn("account_id", F.lit("END")).withColumn("event_time", F.expr("timestamp'2024-03-01 00:00:00'"))
    write_in_order(rows.unionByName(end), folder, "event_time", files=7)
    return rows, folder


def streamed(spark, in_order, tmp_path, operator):
    """What a detector finds in the files, stopped half way and started again."""
    rows, folder = in_order
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):
        query = start_table(operator(stream), out, "detector", checkpoint, available_now=True)
        query.awaitTermination()
    return spark.read.parquet(out).where("account_id <> 'END'")


@pytest.mark.parametrize(
    "operator, batch",
    [
        (detecting.geo_impossible_stream, detectors.geo_impossible),
        (detecting.card_testing_stream, detectors.card_testing),
        (detecting.device_switching_stream, detectors.device_switching),
    ],
    ids=["geo", "card", "device"],
)
def test_detectors_in_the_stream_find_what_they_find_in_the_table(spark, in_order, tmp_path, operator, batch):
    expected = batch(in_order[0])
    assert expected.count() > 0
    assert_same(streamed(spark, in_order, tmp_path, operator).toPandas(), expected.toPandas())


def test_state_of_detectors_is_removed(spark, in_order, tmp_path):
    """After the last row nothing but its own account is remembered."""
    streamed(spark, in_order, tmp_path, detecting.geo_impossible_stream)
    state = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "cp"))
    assert {r[0] for r in state.selectExpr("key.account_id").collect()} <= {"END"}


def test_every_batch_reports_into_a_table(spark, in_order, tmp_path):
    import time

    rows, folder = in_order
    listener = ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        counted = detecting.device_switching_stream(stream.observe("seen", F.count("*").alias("n")))
        start_table(counted, str(tmp_path / "out"), "reported", str(tmp_path / "cp"), available_now=True).awaitTermination()
        for _ in range(60):
            time.sleep(0.5)
            try:
                table = spark.read.parquet(str(tmp_path / "progress"))
                if table.where("input_rows > 0").count() == 7:
                    break
            except Exception:  # not there yet
                continue
    finally:
        spark.streams.removeListener(listener)
    table = spark.read.parquet(str(tmp_path / "progress")).cache()
    assert table.agg({"input_rows": "sum"}).first()[0] == rows.count() + 1
    assert table.where("input_rows > 0 and duration_ms > 0 and state_rows >= 0 and name = 'reported'").count() == 7
    seen = table.where("input_rows > 0").selectExpr("cast(get_json_object(observed['seen'], '$.n') as bigint) as n")
    assert seen.agg({"n": "sum"}).first()[0] == rows.count() + 1
