"""The scoring stream: messages in, scored transactions and alerts out.

Open sessions come from keyed state (``streaming.sessions``), everything else from the operators
that tables use. All writes go to places named after the batch, so a batch that runs again
after a failure replaces its own output and changes nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.config import ALERT_THRESHOLD, LATENCY_BOUNDS_MS, SCORE_BOUNDS
from ledgerwatch.functions.columns import micros
from ledgerwatch.functions.scores import score_transactions
from ledgerwatch.operators.alerts import live_feed, raise_alerts
from ledgerwatch.operators.sketches import group_summary, heavy_candidates, quantile_summary, quantiles
from ledgerwatch.operators.velocity import session_velocity
from ledgerwatch.session import checkpoint_root
from ledgerwatch.sources.messages import alert_messages, quarantined
from ledgerwatch.streaming.sessions import with_open_sessions


@dataclass(frozen=True)
class ScoringJob:
    """Where the stream writes, and how it scores.

    ``publish``, if given, receives each batch of alert messages (``key``, ``value``).
    """

    output: str
    threshold: float = ALERT_THRESHOLD
    publish: Callable[[DataFrame], None] | None = None

    def place(self, table: str, batch_id: int) -> str:
        return f"{self.output}/{table}/batch_id={batch_id}"

    def run(self, rows: DataFrame, batch_id: int) -> None:
        """Score one micro-batch of decoded messages, among them the sessions that were open before it."""
        started = time.monotonic()
        spark = rows.sparkSession
        # The size of a micro-batch is limited by the source; state is updated once and the result kept.
        rows = rows.persist()
        try:
            carried = rows.where("carried_account is not null").selectExpr(
                "carried_account as account_id", "carried_n", "carried_units", "carried_last_us"
            )
            read, found = Observation(), Observation()
            decoded = rows.where("carried_account is null").observe(read, *map(F.expr, READ))
            good = decoded.where("reason is null").select(*[c for c in rows.columns if c not in NOT_SCORED])
            scored = score_transactions(session_velocity(good, skew=None, earlier=carried))
            scored = scored.withColumn("scored_at", F.current_timestamp())
            self.write(scored.observe(found, *score_measures()), "scored", batch_id)
            if read.get["faulty"]:
                self.write(quarantined(rows.where("carried_account is null")), "quarantine", batch_id)
        finally:
            rows.unpersist()
        # From here on the written table is read, nothing is scored twice.
        scored = spark.read.schema(scored.schema).parquet(self.place("scored", batch_id))
        latency = f"({micros('scored_at')} - {micros('kafka_timestamp')}) / 1000D"
        raised = Observation()
        alerts = raise_alerts(scored, latency, "scored_at", self.threshold)
        self.write(alerts.observe(raised, *alert_measures()), "alerts", batch_id)
        written = spark.read.schema(alerts.schema).parquet(self.place("alerts", batch_id))
        self.keep_feed(spark, written, batch_id)
        if self.publish is not None:
            self.publish(alert_messages(written))
        self.log(spark, batch_id, {**read.get, **found.get, **raised.get}, time.monotonic() - started)

    def write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.place(table, batch_id))

    def keep_feed(self, spark: SparkSession, alerts: DataFrame, batch_id: int) -> None:
        """The feed with the batch's alerts.

        It has a fixed length and two places, which batches write in turn: a batch reads the one
        that it does not write. A new output folder starts with an empty feed.
        """
        try:
            alerts = alerts.unionByName(spark.read.schema(alerts.schema).parquet(self.feed_place(batch_id - 1)))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        live_feed(alerts).coalesce(1).write.mode("overwrite").parquet(self.feed_place(batch_id))

    def feed_place(self, batch_id: int) -> str:
        return f"{self.output}/feed/slot={batch_id % 2}"

    def log(self, spark: SparkSession, batch_id: int, counts: dict, seconds: float) -> None:
        """One row per batch: rows, faulty rows, alerts, time taken, rate, and the histograms of scores and latencies."""
        row = spark.range(0, 1, 1, 1).selectExpr(
            f"{counts['rows']}L as row_count",
            f"{counts['faulty']}L as faulty_count",
            f"{counts['alerts']}L as alert_count",
            f"{seconds * 1000:.1f}D as elapsed_ms",
            f"{counts['rows'] / max(seconds, 0.001):.1f}D as rows_per_second",
            bucket_rows("score", SCORE_BOUNDS, counts),
            bucket_rows("latency_ms", LATENCY_BOUNDS_MS, counts),
            *summaries(counts),
            "current_timestamp() as logged_at",
        )
        self.write(row, "batches", batch_id)


#: What is decoded for the state and the quarantine only.
NOT_SCORED = {"message_key", "message", "reason", "carried_account", "carried_n", "carried_units", "carried_last_us"}
READ = ["count(*) as rows", "count(reason) as faulty"]


def bucket_measures(name: str, value: str, bounds: list[float]) -> list[Column]:
    """A histogram as aggregates that are taken while the rows are written."""
    below = [f"count_if({value} <= {bound}D) as {name}_{k}" for k, bound in enumerate(bounds)]
    return [F.expr(m) for m in [*below, f"count({value}) as {name}_n", f"sum(cast({value} as decimal(30,12))) as {name}_sum"]]


#: Columns of alerts whose heavy groups are followed, and the share of alerts from which a group is heavy.
FOLLOWED_GROUPS = ["account_id", "merchant_category", "country"]
HEAVY_SHARE = 0.01


def score_measures() -> list[Column]:
    sketch = F.expr(f"{quantile_summary('fraud_score')} as score_sketch")
    return [*bucket_measures("score", "fraud_score", SCORE_BOUNDS), sketch]


def alert_measures() -> list[Column]:
    groups = [f"{group_summary(name, HEAVY_SHARE)} as {name}_groups" for name in FOLLOWED_GROUPS]
    more = ["count(*) as alerts", f"{quantile_summary('detection_latency_ms')} as latency_ms_sketch", *groups]
    return [*map(F.expr, more), *bucket_measures("latency_ms", "detection_latency_ms", LATENCY_BOUNDS_MS)]


def summaries(counts: dict) -> list[str]:
    """The sketches of a batch as columns of its log."""
    sketches = [f"X'{bytes(counts[f'{name}_sketch']).hex()}' as {name}_sketch" for name in ("score", "latency_ms")]
    groups = []
    for name in FOLLOWED_GROUPS:
        of = counts[f"{name}_groups"]
        groups.append(
            f"named_struct('sketch', X'{bytes(of.sketch).hex()}', 'maxItemsTracked', {of.maxItemsTracked}, "
            f"'itemDataType', cast(null as string), 'itemDataTypeDDL', '{of.itemDataTypeDDL}') as {name}_groups"
        )
    return [*sketches, *groups]


def bucket_rows(name: str, bounds: list[float], counts: dict) -> str:
    """The measures of a histogram as an array of ``le, cumulative, value_sum, value_count``."""
    n, sum_ = counts[f"{name}_n"], counts[f"{name}_sum"] or 0
    both = f"cast('{sum_}' as decimal(38,12)) as value_sum, {n}L as value_count"
    rows = [f"struct('{bound:g}' as le, {counts[f'{name}_{k}']}L as cumulative, {both})" for k, bound in enumerate(bounds)]
    return f"array({', '.join([*rows, f"struct('+Inf' as le, {n}L as cumulative, {both})"])}) as {name}_buckets"


def kept_buckets(spark: SparkSession, output: str) -> DataFrame:
    """``metric, le, cumulative, value_sum, value_count`` over all batches so far: of scores, and of
    the alerts' latency.
    """
    metrics = [f"struct('{name}' as metric, {name}_buckets as buckets)" for name in ("score", "latency_ms")]
    batches = spark.read.parquet(f"{output}/batches").selectExpr(f"inline(array({', '.join(metrics)}))")
    return batches.selectExpr("metric", "inline(buckets)").groupBy("metric", "le").agg(
        F.expr("sum(cumulative) as cumulative"),
        F.expr("cast(sum(value_sum) as double) as value_sum"),
        F.expr("sum(value_count) as value_count"),
    )


def kept_percentiles(
    spark: SparkSession, output: str, name: str, points: dict[str, float], batches: str = "true"
) -> DataFrame:
    """One row with a column per point and ``n``: quantiles of ``score`` or ``latency_ms`` over the ``batches`` that meet a
    condition on ``batch_id`` or ``logged_at``. Only the log is read, one sketch per batch.
    """
    return quantiles(spark.read.parquet(f"{output}/batches").where(batches), f"{name}_sketch", points)


def kept_groups(spark: SparkSession, output: str, name: str, batches: str = "true") -> DataFrame:
    """``item, estimate`` of the groups of alerts by ``name`` that may have ``HEAVY_SHARE`` of those of the ``batches``: all
    that have it are among them. Only the log is read.
    """
    return heavy_candidates(spark.read.parquet(f"{output}/batches").where(batches), f"{name}_groups", HEAVY_SHARE)


def start_scoring(
    messages: DataFrame,
    job: ScoringJob,
    checkpoint: str | None = None,
    every: str = "2 seconds",
    available_now: bool = False,
    name: str = "ledgerwatch_scoring",
    earlier: DataFrame | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` ends it when the messages at hand are done.

    Without a checkpoint it goes on with the open sessions ``earlier`` (``operators.velocity.open_sessions``).
    """
    folder = checkpoint or f"{checkpoint_root(messages.sparkSession)}/{name}"
    rows = with_open_sessions(messages, earlier=earlier)
    writer = rows.writeStream.queryName(name).option("checkpointLocation", folder).foreachBatch(job.run)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    # Old state goes when messages come; without this, it would ask for empty batches all the time.
    conf, key = messages.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return writer.trigger(**trigger).start()
    finally:
        conf.set(key, before)
