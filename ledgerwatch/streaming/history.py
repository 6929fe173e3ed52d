"""The newest alerts of each account, kept as state by a stream of alerts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerwatch.config import HISTORY_HOURS, HISTORY_PER_ACCOUNT, WATERMARK
from ledgerwatch.functions.columns import micros
from ledgerwatch.session import checkpoint_root
from ledgerwatch.streaming.sessions import ROCKSDB

KEPT = ["detected_us", "transaction_id", "fraud_score", "label"]
ALERT = "detected_us bigint, transaction_id string, fraud_score double, label string"
CHANGED = "account_id string, kept int, newest_us bigint"


class AlertHistory(StatefulProcessor):
    """Keeps an account's newest alerts until its last one is ``keep_ms`` old by event time."""

    def __init__(self, most: int, keep_ms: int):
        self.most, self.keep_ms = most, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alerts = handle.getListState("alerts", ALERT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = pd.DataFrame(list(self.alerts.get()), columns=KEPT)
        new = [frame[KEPT] for frame in rows]
        merged = pd.concat([before, *new] if len(before) else new, ignore_index=True).drop_duplicates()
        newest = merged.sort_values(["detected_us", "transaction_id"], ascending=[False, True]).head(self.most)
        self.alerts.put(list(newest.itertuples(index=False, name=None)))
        # Each alert puts the end off.
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        last = int(newest["detected_us"].iloc[0])
        self.handle.registerTimer(last // 1000 + self.keep_ms)
        yield pd.DataFrame([(key[0], len(newest), last)], columns=["account_id", "kept", "newest_us"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alerts.clear()
        yield pd.DataFrame([(key[0], 0, None)], columns=["account_id", "kept", "newest_us"])

    def close(self) -> None:
        pass


def alert_history(
    alerts: DataFrame, keep: int = HISTORY_PER_ACCOUNT, hours: int = HISTORY_HOURS, late: str = WATERMARK
) -> DataFrame:
    """A stream of alerts as ``account_id, kept, newest_us``: how many of an account's alerts are kept now.

    The alerts themselves are the state of the query (``kept_history``). Equal alerts count once, so one that
    is delivered again changes nothing. An account's alerts of a micro-batch are worked on together.
    """
    alerts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = alerts.selectExpr(
        "account_id", f"{micros('detected_at')} as detected_us", "transaction_id", "fraud_score", "label",
        "cast(detected_at as timestamp) as detected_at",
    )
    return (
        timed.withWatermark("detected_at", late)
        .groupBy("account_id")
        .transformWithStateInPandas(AlertHistory(keep, hours * 3_600_000), CHANGED, "Update", "EventTime")
    )


def start_history(
    alerts: DataFrame, checkpoint: str | None = None, every: str = "2 seconds", available_now: bool = False,
    name: str = "ledgerwatch_history",
) -> StreamingQuery:
    """Keep the history of a stream of alerts; what changed is not written anywhere else."""
    folder = checkpoint or f"{checkpoint_root(alerts.sparkSession)}/{name}"
    writer = alert_history(alerts).writeStream.queryName(name).outputMode("update").format("noop")
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.option("checkpointLocation", folder).trigger(**trigger).start()


def kept_history(spark: SparkSession, checkpoint: str, hours: int = HISTORY_HOURS) -> DataFrame:
    """``account_id, position, transaction_id, fraud_score, label, detected_at`` of all accounts that had an alert in
    the last ``hours`` before the newest one of all, as of the last committed batch.

    The end of an account's history comes with the watermark, which follows the newest alert; what has not been removed
    yet is left out here.
    """
    state = spark.read.format("statestore").option("stateVarName", "alerts").load(checkpoint)
    kept = state.selectExpr("key.account_id", "list_element.*")
    position = "cast(row_number() over (partition by account_id order by detected_us desc, transaction_id) as bigint) as position"
    dated = kept.selectExpr("*", position, "max(detected_us) over (partition by account_id) as last_us")
    now = kept.agg(F.max("detected_us")).scalar()
    return dated.where(F.col("last_us") > now - hours * 3_600_000_000).selectExpr(
        "account_id", "position", "transaction_id", "fraud_score", "label", "timestamp_micros(detected_us) as detected_at"
    )
