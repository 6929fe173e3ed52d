"""The detectors along an account's time line as streams.

What an account's next rows need to know is keyed state: its last country, and the times of its recent micro amounts.
Event-time timers remove it when it can matter no more. The operators see the few columns they need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerwatch.config import MICROS_PER_SECOND, WATERMARK
from ledgerwatch.functions.columns import micros
from ledgerwatch.functions.rules import RULES_BY_NAME
from ledgerwatch.operators.detectors import GEO_MINUTES, WINDOW_SECONDS
from ledgerwatch.streaming.sessions import ROCKSDB

STEP = "transaction_id string, account_id string, us bigint, country string, previous_country string, seconds_apart double"
TESTED = "transaction_id string, account_id string, us bigint, amount double, micro_count bigint"


class Remembered(StatefulProcessor):
    """State of an account that an event-time timer removes ``keep_us`` after the account's newest row."""

    def __init__(self, keep_us: int):
        self.keep_us = keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = self.open(handle)

    def open(self, handle: StatefulProcessorHandle):
        raise NotImplementedError

    def batch(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        """An account's rows of a micro-batch in order of time and id; the timer is set anew."""
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["us", "transaction_id"], kind="stable", ignore_index=True)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((int(frame["us"].iloc[-1]) + self.keep_us) // 1000 + 1)
        return frame

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class LastCountry(Remembered):
    """Rows in another country than the one before, less than ``keep_us`` later."""

    def open(self, handle):
        return handle.getValueState("last", "us bigint, country string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.batch(rows)
        us, country = frame["us"].to_numpy(), frame["country"].to_numpy(object)
        before = self.state.get() or (None, None)
        # Without a row before, the first row is compared with itself and not found.
        then = np.concatenate([[us[0] if before[0] is None else before[0]], us[:-1]])
        there = np.concatenate([[country[0] if before[0] is None else before[1]], country[:-1]]).astype(object)
        known = ~(pd.isna(country) | pd.isna(there))
        found = np.flatnonzero(known & (there != country) & (us - then < self.keep_us))
        self.state.update((int(us[-1]), None if pd.isna(country[-1]) else country[-1]))
        if len(found):
            out = frame.iloc[found][["transaction_id", "us", "country"]].assign(
                account_id=key[0], previous_country=there[found], seconds_apart=(us - then)[found] / MICROS_PER_SECOND
            )
            yield out[["transaction_id", "account_id", "us", "country", "previous_country", "seconds_apart"]]


class MicroAmounts(Remembered):
    """Large amounts with ``least`` micro amounts or more in the ``keep_us`` up to them."""

    def __init__(self, keep_us: int, least: int):
        super().__init__(keep_us)
        self.least = least

    def open(self, handle):
        return handle.getListState("micro", "us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.batch(rows)
        before = np.array([us for (us,) in self.state.get()], np.int64)
        times = np.sort(np.concatenate([before, frame.loc[frame["is_micro"], "us"].to_numpy()]))
        large = frame[~frame["is_micro"]]
        us = large["us"].to_numpy()
        counts = np.searchsorted(times, us, side="right") - np.searchsorted(times, us - self.keep_us, side="left")
        kept = times[times >= int(frame["us"].iloc[-1]) - self.keep_us]
        if len(kept):
            self.state.put([(int(t),) for t in kept])
        else:
            self.state.clear()
        found = counts >= self.least
        if found.any():
            out = large[found][["transaction_id", "us", "amount"]].assign(account_id=key[0], micro_count=counts[found])
            yield out[["transaction_id", "account_id", "us", "amount", "micro_count"]]


def _keyed(transactions: DataFrame, late: str, *columns: str) -> DataFrame:
    transactions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = transactions.withColumn("event_time", F.expr("cast(event_time as timestamp)")).withWatermark("event_time", late)
    return rows.selectExpr("transaction_id", "account_id", "event_time", f"{micros()} as us", *columns)


def geo_impossible_stream(transactions: DataFrame, minutes: int = GEO_MINUTES, late: str = WATERMARK) -> DataFrame:
    """``operators.detectors.geo_impossible`` of a stream.

    The rows of a micro-batch are put in order; a row older than those of earlier batches is compared with the last of
    them.
    """
    keep = minutes * 60 * MICROS_PER_SECOND
    found = _keyed(transactions, late, "country").groupBy("account_id").transformWithStateInPandas(
        LastCountry(keep), STEP, "Append", "EventTime"
    )
    return found.selectExpr(
        "transaction_id", "account_id", "timestamp_micros(us) as event_time", "country", "previous_country", "seconds_apart"
    )


def card_testing_stream(
    transactions: DataFrame, min_micro: int = 1, seconds: int = WINDOW_SECONDS, late: str = WATERMARK
) -> DataFrame:
    """``operators.detectors.card_testing`` of a stream; micro amounts that arrive in a later micro-batch than the large
    one do not count for it. The state of an account is the times of its micro amounts of the last five minutes.
    """
    micro = RULES_BY_NAME["MICRO_AMOUNT_CARD_TEST"].predicate
    large = RULES_BY_NAME["HIGH_AMOUNT_3K"].predicate
    rows = _keyed(transactions.where(f"({micro}) or ({large})"), late, "amount", f"{micro} as is_micro")
    found = rows.groupBy("account_id").transformWithStateInPandas(
        MicroAmounts(seconds * MICROS_PER_SECOND, min_micro), TESTED, "Append", "EventTime"
    )
    return found.selectExpr("transaction_id", "account_id", "timestamp_micros(us) as event_time", "amount", "micro_count")


def device_switching_stream(
    transactions: DataFrame, min_devices: int = 3, length_seconds: int = WINDOW_SECONDS, late: str = WATERMARK
) -> DataFrame:
    """``operators.detectors.device_switching`` of a stream, for append mode: windows as they close.

    Rows are combined per device first, so a window's state has one row per device and not per transaction.
    """
    rows = transactions.withColumn("event_time", F.expr("cast(event_time as timestamp)")).withWatermark("event_time", late)
    window = F.window("event_time", f"{length_seconds} seconds").alias("window")
    devices = rows.groupBy(window, "account_id", "device_type").agg(F.count("*").alias("n"))
    again = F.window("window", f"{length_seconds} seconds").alias("window")
    used = devices.groupBy(again, "account_id").agg(F.expr("count(device_type) as devices"))
    return used.where(f"devices >= {min_devices}").selectExpr("window.start as window_start", "account_id", "devices")
