"""Streams against the batch operators on the same rows."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions.scores import score_transactions
from ledgerwatch.operators.alerts import global_stats
from ledgerwatch.operators.velocity import session_velocity
from ledgerwatch.operators.windows import account_sessions, window_activity
from ledgerwatch.sources import events
from ledgerwatch.sources.messages import decode_transactions, parse_transactions, quarantine
from ledgerwatch.sources.streams import file_messages, source
from ledgerwatch.streaming.lifecycle import progress, run_until_one_ends
from ledgerwatch.streaming.probes import probe_latency_stream
from ledgerwatch.streaming.scoring import ScoringJob, start_scoring
from ledgerwatch.streaming.sessions import live_features, with_open_sessions
from ledgerwatch.streaming.velocity import session_stream, start_monitor, start_table, window_monitor, window_stream
from tests.compare import assert_same

FILES = 5


def write_in_order(rows, folder, time_column, files=FILES):
    """One file per time span, with rising modification times."""
    ordered = rows.orderBy(time_column).toPandas()
    step = -(-len(ordered) // files)
    for i in range(files):
        part = ordered.iloc[i * step : (i + 1) * step]
        name = f"{folder}/part-{i}.parquet"
        part.to_parquet(name, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(name, (time.time() - 1000 + i, time.time() - 1000 + i))


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    path = tmp_path_factory.mktemp("messages")
    write_in_order(events.messages(spark, small), str(path), "timestamp")
    return str(path)


@pytest.fixture(scope="module")
def scored_run(spark, folder, tmp_path_factory):
    """The scoring stream, stopped after two batches and started again from its checkpoint."""
    output = str(tmp_path_factory.mktemp("scored"))
    checkpoint = str(tmp_path_factory.mktemp("checkpoint"))
    job = ScoringJob(output)

    class Interrupted(Exception):
        pass

    def fail_in_third(rows, batch_id):
        job.run(rows, batch_id)
        if batch_id == 2:
            raise Interrupted("lost after writing, before the commit")

    stream = file_messages(spark, folder)
    query = (
        with_open_sessions(stream).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(fail_in_third)
        .trigger(availableNow=True)
        .start()
    )
    with pytest.raises(Exception, match="lost after writing"):
        query.awaitTermination()
    query = start_scoring(file_messages(spark, folder), job, checkpoint, available_now=True)
    query.awaitTermination()
    return output, query


def test_stream_scores_like_batch_and_survives_a_replayed_batch(spark, folder, scored_run):
    output, _ = scored_run
    columns = ["transaction_id", "window_count", "window_spend", "fraud_score"]
    streamed = spark.read.parquet(f"{output}/scored").select(*columns)
    batch = score_transactions(session_velocity(parse_transactions(spark.read.parquet(folder)))).select(*columns)
    assert_same(streamed.toPandas(), batch.toPandas())


def test_stream_writes_alerts_quarantine_and_batch_log(spark, folder, scored_run):
    output, _ = scored_run
    scored = spark.read.parquet(f"{output}/scored")
    alerts = spark.read.parquet(f"{output}/alerts")
    assert alerts.count() == scored.where("fraud_score >= 0.65D").count() > 0
    assert alerts.where("detection_latency_ms is null or detected_at is null").isEmpty()
    bad = quarantine(spark.read.parquet(folder))
    assert spark.read.parquet(f"{output}/quarantine").count() == bad.count() > 0
    log = spark.read.parquet(f"{output}/batches")
    assert log.count() == FILES
    assert log.agg({"row_count": "sum"}).first()[0] == scored.count() + bad.count()
    assert log.agg({"faulty_count": "sum"}).first()[0] == bad.count()
    assert log.agg({"alert_count": "sum"}).first()[0] == alerts.count()


def test_stream_keeps_histograms_and_feed(spark, scored_run):
    from ledgerwatch.operators.alerts import live_feed
    from ledgerwatch.operators.analytics import latency_buckets, score_buckets
    from ledgerwatch.streaming.scoring import kept_buckets

    output, _ = scored_run
    scored, alerts = spark.read.parquet(f"{output}/scored"), spark.read.parquet(f"{output}/alerts")
    columns = ["le", "cumulative", "value_count"]
    kept = kept_buckets(spark, output)
    for metric, expected in (("score", score_buckets(scored)), ("latency_ms", latency_buckets(alerts, "detection_latency_ms"))):
        own = kept.where(f"metric = '{metric}'")
        assert_same(own.select(*columns).toPandas(), expected.select(*columns).toPandas())
        assert own.first().value_sum == pytest.approx(expected.first().value_sum, abs=0.1)
    feed = spark.read.parquet(f"{output}/feed/slot={(FILES - 1) % 2}").select("transaction_id", "detected_at")
    assert_same(feed.toPandas(), live_feed(alerts).select("transaction_id", "detected_at").toPandas())


def test_log_gives_percentiles_and_groups_of_any_span(spark, scored_run):
    from ledgerwatch.operators.sketches import RANK_ERROR
    from ledgerwatch.streaming.scoring import HEAVY_SHARE, kept_groups, kept_percentiles

    output, _ = scored_run
    points = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    for span in ("true", "batch_id between 1 and 2"):
        scored = spark.read.parquet(f"{output}/scored").where(span)
        found = kept_percentiles(spark, output, "score", points, span).first()
        assert found.n == scored.count()
        for name, p in points.items():
            ranks = scored.selectExpr(f"avg(cast(fraud_score < {found[name]!r}D as int))", f"avg(cast(fraud_score <= {found[name]!r}D as int))").first()
            assert ranks[0] <= p + RANK_ERROR and ranks[1] >= p - RANK_ERROR
        alerts = spark.read.parquet(f"{output}/alerts").where(span)
        n = alerts.count()
        for name in ("account_id", "country"):
            counts = {r[name]: r["count"] for r in alerts.groupBy(name).count().collect()}
            groups = {r.item: r.estimate for r in kept_groups(spark, output, name, span).collect()}
            assert {k: v for k, v in counts.items() if v >= HEAVY_SHARE * n}.items() <= groups.items()


def test_progress_reports_batches(scored_run):
    _, query = scored_run
    reports = progress(query)
    assert reports.where("input_rows > 0").count() == FILES - 2
    assert reports.where("rows_per_second > 0").count() >= FILES - 2


def transactions_stream(spark, folder):
    return parse_transactions(source(spark, "files", path=folder))


def closed(rows, column, newest):
    """What append mode has emitted: windows that ended before the final watermark."""
    return rows.where(f"{column} <= timestamp'{newest}' - interval 30 seconds")


def newest_event(spark, folder):
    return parse_transactions(spark.read.parquet(folder)).agg({"event_time": "max"}).first()[0]


def test_window_stream_equals_batch(spark, folder, tmp_path):
    query = start_table(
        window_stream(transactions_stream(spark, folder)),
        str(tmp_path / "out"), "velocity", str(tmp_path / "cp"), available_now=True,
    )
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = window_activity(parse_transactions(spark.read.parquet(folder)))
    newest = newest_event(spark, folder)
    assert streamed.count() > 1000
    assert_same(streamed.toPandas(), closed(batch, "window_end", newest).toPandas())


def test_window_monitor_updates(spark, folder, tmp_path):
    rows = window_monitor(transactions_stream(spark, folder))
    query = start_monitor(rows, "memory", "monitor", str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    shown = spark.table("monitor")
    newest = shown.groupBy("window_start", "account_id").agg({"window_txn_count": "max"})
    batch = window_activity(parse_transactions(spark.read.parquet(folder)))
    assert newest.count() == batch.count()
    assert newest.agg({"max(window_txn_count)": "sum"}).first()[0] == batch.agg({"window_txn_count": "sum"}).first()[0]


def test_tumbling_window_stream_equals_batch(spark, folder, tmp_path):
    rows = window_stream(transactions_stream(spark, folder), slide="5 minutes")
    query = start_table(rows, str(tmp_path / "out"), "tumbling", str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    batch = window_activity(parse_transactions(spark.read.parquet(folder)), slide_seconds=300)
    newest = newest_event(spark, folder)
    assert_same(spark.read.parquet(str(tmp_path / "out")).toPandas(), closed(batch, "window_end", newest).toPandas())


def test_running_totals_of_written_alerts(spark, scored_run, tmp_path):
    output, _ = scored_run
    alerts = spark.read.parquet(f"{output}/alerts")
    totals = global_stats(spark.readStream.schema(alerts.schema).option("maxFilesPerTrigger", 2).parquet(f"{output}/alerts"))
    query = start_monitor(totals, "memory", "totals", str(tmp_path / "cp"), available_now=True, mode="complete")
    query.awaitTermination()
    assert spark.table("totals").first() == global_stats(alerts).first()


def test_session_stream_equals_batch(spark, folder, tmp_path):
    query = start_table(
        session_stream(transactions_stream(spark, folder)),
        str(tmp_path / "out"), "sessions", str(tmp_path / "cp"), available_now=True,
    )
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = account_sessions(parse_transactions(spark.read.parquet(folder)))
    newest = newest_event(spark, folder)
    ended = closed(batch.selectExpr("*", "session_last + interval 300 seconds as gone"), "gone", newest).drop("gone")
    assert streamed.count() > 50
    assert_same(streamed.toPandas(), ended.toPandas())


def test_late_rows_are_dropped_and_reported(spark, tmp_path):
    base = "timestamp'2024-01-01 00:00:00'"
    folder = tmp_path / "in"
    folder.mkdir()
    for i, minute in enumerate([0, 60, 61, 1, 62]):
        body = (
            f"to_json(struct('T{i}' as transaction_id, 'A' as account_id, 'M' as merchant_id, 5.0D as amount, "
            f"date_format({base} + interval {minute} minutes, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as timestamp))"
        )
        message = spark.range(1).selectExpr(
            "cast('A' as binary) as key", f"cast({body} as binary) as value", f"{base} as timestamp"
        )
        name = f"{folder}/part-{i}.parquet"
        message.toPandas().to_parquet(name, index=False, coerce_timestamps="us")
        os.utime(name, (time.time() - 100 + i, time.time() - 100 + i))
    rows = window_monitor(transactions_stream(spark, str(folder)))
    query = start_monitor(rows, "memory", "late", str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    assert progress(query).agg({"late_rows": "sum"}).first()[0] > 0
    first_windows = f"window_start <= {base} + interval 1 minute and window_end <= {base} + interval 6 minutes"
    late_windows = spark.table("late").where(first_windows)
    assert late_windows.agg({"window_txn_count": "max"}).first()[0] == 1


def test_probe_streams_join(spark, small, tmp_path):
    rows = events.transactions(spark, small).selectExpr(
        "transaction_id", "cast(event_time as timestamp) as sent_at", "is_fraud",
        "cast(event_time as timestamp) + make_dt_interval(0, 0, 0, latency_ms / 1000) as detected_at",
        "'FRAUD' as label",
    )
    for name, columns, key in [("probes", ["transaction_id", "sent_at", "is_fraud"], "sent_at"),
                               ("alerts", ["transaction_id", "label", "detected_at"], "detected_at")]:
        (tmp_path / name).mkdir()
        write_in_order(rows.select(*columns), str(tmp_path / name), key, files=3)

    probes = spark.readStream.schema("transaction_id string, sent_at timestamp, is_fraud boolean")
    alerts = spark.readStream.schema("transaction_id string, label string, detected_at timestamp")
    joined = probe_latency_stream(probes.parquet(str(tmp_path / "probes")), alerts.parquet(str(tmp_path / "alerts")))
    query = start_table(joined, str(tmp_path / "out"), "probes", str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_live_coverage_equals_batch(spark, small, tmp_path):
    """Every probe comes out once, with its alert or without; alerts that come twice count once."""
    from ledgerwatch.operators.quality import coverage, probe_coverage
    from ledgerwatch.streaming.probes import probe_outcomes_stream

    rows = events.transactions(spark, small).selectExpr(
        "transaction_id", "cast(event_time as timestamp) as sent_at", "is_fraud", "concat('A', transaction_id) as alert_id",
        "cast(event_time as timestamp) + make_dt_interval(0, 0, 0, latency_ms / 1000) as detected_at",
        "if(amount > 100, 'FRAUD', 'REVIEW') as label", "pmod(hash(transaction_id), 7) as part",
    )
    alerts = rows.where("part < 4")
    alerts = alerts.unionByName(alerts.where("part = 1").withColumn("detected_at", F.expr("detected_at + interval 1 second")))
    # What comes long after all the others lets the stream give up on probes without an alert.
    last = "timestamp'2024-02-01 00:00:00'"
    end = spark.range(1).selectExpr(
        "'END' as transaction_id", f"{last} as sent_at", "false as is_fraud", "'AEND' as alert_id", f"{last} as detected_at",
        "'FRAUD' as label", "0 as part",
    )
    tables = {
        "probes": (rows.unionByName(end).select("transaction_id", "sent_at", "is_fraud"), "sent_at"),
        "alerts": (alerts.unionByName(end).select("alert_id", "transaction_id", "label", "detected_at"), "detected_at"),
    }
    streams = {}
    for name, (table, key) in tables.items():
        (tmp_path / name).mkdir()
        write_in_order(table, str(tmp_path / name), key, files=4)
        reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
        streams[name] = reader.parquet(str(tmp_path / name))
    outcomes = probe_outcomes_stream(streams["probes"], streams["alerts"])
    start_table(outcomes, str(tmp_path / "out"), "outcomes", str(tmp_path / "cp"), available_now=True).awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out")).where("transaction_id <> 'END'")
    assert written.count() == written.select("transaction_id").distinct().count() == rows.count()
    assert coverage(written).first() == probe_coverage(rows.select("transaction_id", "sent_at", "is_fraud"), alerts).first()
    assert 0 < written.where("not alerted").count() < rows.count()


def test_replayed_batch_publishes_each_alert_once(spark, folder, tmp_path):
    """The third batch is lost after publishing, and publishes again; a reader has each alert once."""
    from ledgerwatch.sources.messages import decode_alerts
    from ledgerwatch.streaming.probes import alerts_once

    topic, lost = str(tmp_path / "topic"), []

    def publish(messages):
        messages.write.mode("append").parquet(topic)
        if spark.read.parquet(topic).count() > 40 and not lost:
            lost.append(True)
            raise RuntimeError("lost after publishing")

    job = ScoringJob(str(tmp_path / "out"), publish=publish)
    with pytest.raises(Exception, match="lost after publishing"):
        start_scoring(file_messages(spark, folder), job, str(tmp_path / "cp"), available_now=True).awaitTermination()
    start_scoring(file_messages(spark, folder), job, str(tmp_path / "cp"), available_now=True).awaitTermination()
    sent = spark.read.parquet(topic)
    alerts = spark.read.parquet(f"{job.output}/alerts").select("alert_id")
    assert sent.count() > alerts.count()
    assert_same(alerts_once(decode_alerts(sent)).select("alert_id").toPandas(), alerts.toPandas())
    stream = alerts_once(decode_alerts(spark.readStream.schema(sent.schema).parquet(topic)), "1 day").select("alert_id")
    start_table(stream, str(tmp_path / "read"), "once", str(tmp_path / "cp2"), available_now=True).awaitTermination()
    assert_same(spark.read.parquet(str(tmp_path / "read")).toPandas(), alerts.toPandas())


def test_new_output_folder_with_an_old_checkpoint(spark, folder, tmp_path):
    """The feed starts anew where the stream's earlier output is not."""
    first, second = ScoringJob(str(tmp_path / "first")), ScoringJob(str(tmp_path / "second"))
    import shutil

    (tmp_path / "in").mkdir()
    files = sorted(os.listdir(folder))
    for step, job in ((files[:1], first), (files[1:2], second)):
        for name in step:
            shutil.copy(f"{folder}/{name}", tmp_path / "in")
        start_scoring(file_messages(spark, str(tmp_path / "in")), job, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert spark.read.parquet(f"{second.output}/feed").count() > 0


def test_compaction_changes_no_row(spark, scored_run, tmp_path):
    """Batches move into segments by day; a compaction that stopped before or after its segment was complete is done again."""
    import shutil

    from ledgerwatch.streaming.compaction import compact, written

    output = str(tmp_path / "out")
    shutil.copytree(scored_run[0], output)
    for table in ("scored", "alerts", "batches", "quarantine"):
        before = spark.read.parquet(f"{output}/{table}").toPandas()
        # An incomplete segment counts for nothing.
        os.makedirs(f"{output}/{table}_days/batches=0-1")
        assert written(spark, output, table).count() == len(before)
        kept = f"{tmp_path}/kept"
        shutil.copytree(f"{output}/{table}/batch_id=1", kept)
        assert compact(spark, output, table, 2) == 3
        assert sorted(n for n in os.listdir(f"{output}/{table}") if "batch" in n) == ["batch_id=3", "batch_id=4"]
        # A batch that was not removed after its segment was written is not read twice, and goes the next time.
        shutil.move(kept, f"{output}/{table}/batch_id=1")
        assert written(spark, output, table).count() == len(before)
        assert compact(spark, output, table, 4) == 2 and compact(spark, output, table, 4) == 0
        after = written(spark, output, table)
        assert after.count() == len(before) and after.where("day is null").isEmpty()
        if table in ("scored", "alerts"):
            key = ["transaction_id", "batch_id"]
            assert_same(after.select(*key).toPandas(), before[key])
            pruned = after.where("day = date'2020-01-01'")
            assert pruned.count() == 0 and "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().toString()


def test_files_by_bytes(spark, folder, tmp_path):
    stream = file_messages(spark, folder, bytes_per_batch=1)
    query = start_table(stream, str(tmp_path / "out"), "bytes", str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    assert progress(query).where("input_rows > 0").count() == FILES


def test_kafka_options():
    from ledgerwatch.sources.streams import kafka_options

    assert kafka_options("a:1,b:2") == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "transactions", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5000", "failOnDataLoss": "false",
    }
    assert kafka_options("a:1", topic="t", per_batch=7, starting="earliest")["maxOffsetsPerTrigger"] == "7"


def test_two_streams_run_and_stop_together(spark, folder, tmp_path):
    spark.streams.resetTerminated()
    scoring = start_scoring(
        file_messages(spark, folder), ScoringJob(str(tmp_path / "out")), str(tmp_path / "cp1"), available_now=True
    )
    monitor = start_monitor(
        window_monitor(transactions_stream(spark, folder)), "noop", "together", str(tmp_path / "cp2"), every="1 second"
    )
    assert {q.name for q in spark.streams.active} >= {"together"}
    run_until_one_ends(spark, [scoring, monitor], timeout=120)
    assert not scoring.isActive and not monitor.isActive


def test_fields_of_unreadable_messages_are_null(spark, folder):
    decoded = decode_transactions(spark.read.parquet(folder))
    assert decoded.count() == spark.read.parquet(folder).count()
    assert decoded.where("transaction_id is null").count() == quarantine(spark.read.parquet(folder)).count()
