"""Open sessions of a stream: each account's session is keyed state of the engine.

The state operator sees three columns of a transaction (account, time, amount) and hands out one row per account
and micro-batch: the session that was open before it. Everything else about a row stays where it is, and the
counters of the rows are the window sums that tables use (``operators.velocity``). Accounts are worked on in groups, so
that what a call costs is paid once a group; the state has an entry for each account.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerwatch.functions.columns import TOTAL, from_units, micros, to_units
from ledgerwatch.operators.velocity import GAP_US
from ledgerwatch.sources.messages import STREAM_FAULT, decode_transactions

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SESSION = f"n bigint, units {TOTAL}, last_us bigint"
CARRIED = f"carried_account string, carried_n bigint, carried_units {TOTAL}, carried_last_us bigint"
#: Groups of accounts, which is how many tasks can work on the state; fixed when a stream first starts.
GROUPS = 64
EXACT = Context(prec=60)

Session = tuple[int, Decimal, int]


def session_after(session: Session | None, us: np.ndarray, units: np.ndarray) -> Session:
    """``(n, units, last_us)`` of an account's session after rows at the sorted times ``us``, given what it was before.

    A row older than the session counts in it and does not move it back.
    """
    n, before, last = session or (0, Decimal(0), int(us[0]))
    known = np.maximum(last, np.concatenate([[last], us[:-1]]))
    pauses = np.flatnonzero(us - known > GAP_US)
    if len(pauses):
        n, before, units = 0, Decimal(0), units[pauses[-1] :]
    return n + len(units), reduce(EXACT.add, units, before), max(last, int(us[-1]))


class OpenSessions(StatefulProcessor):
    """Hands out the sessions that were open before the rows of a group of accounts, and keeps those after them."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sessions = handle.getMapState("sessions", "account_id string", SESSION, self.keep_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for account, n, units, last_us in initialState[["account_id", "n", "units", "last_us"]].itertuples(index=False):
            self.sessions.updateValue((account,), (int(n), units, int(last_us)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        number, accounts = pd.factorize(batch["account_id"])
        us, units = batch["us"].to_numpy(), batch["units"].to_numpy(object)
        order = np.lexsort((us, number))
        us, units = us[order], units[order]
        ends = np.cumsum(np.bincount(number))
        before = []
        for account, start, end in zip(accounts, [0, *ends[:-1]], ends, strict=True):
            session = self.sessions.getValue((account,))
            self.sessions.updateValue((account,), session_after(session, us[start:end], units[start:end]))
            if session is not None:
                before.append((account, *session))
        if before:
            yield pd.DataFrame(before, columns=["carried_account", "carried_n", "carried_units", "carried_last_us"])

    def close(self) -> None:
        pass


def with_open_sessions(
    messages: DataFrame, keep_hours: int = 24, earlier: DataFrame | None = None, groups: int = GROUPS
) -> DataFrame:
    """A stream of decoded messages (``key, value, timestamp`` before) with the reason why one cannot be scored, and
    among them one row for each of their accounts that has an open session (the columns ``carried_...``).

    Both kinds of rows belong to one query, so they come in the same micro-batch; the source is read for each.
    Sessions end by event time, whatever else the stream brings. State that no message has touched for ``keep_hours``
    of the clock is dropped; that is far longer than a session's gap, so a stream may stop that long and go on with its
    backlog. What a batch reads and writes follows the accounts in it, not the open ones. ``earlier`` has the open
    sessions of a table (``account_id, n, units, last_us``, one row per account; ``operators.velocity.open_sessions``):
    a stream without a checkpoint goes on with them.
    """
    conf = messages.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    decoded = decode_transactions(messages).selectExpr("*", f"{STREAM_FAULT} as reason")
    group = f"cast(pmod(xxhash64(account_id), {groups}) as int) as accounts"
    good = decoded.where("reason is null").selectExpr(
        group, "account_id", f"{micros()} as us", f"cast({to_units()} as {TOTAL}) as units"
    )
    if earlier is not None:
        earlier = earlier.selectExpr(group, "account_id", "n", "units", "last_us").groupBy("accounts")
    carried = good.groupBy("accounts").transformWithStateInPandas(
        OpenSessions(keep_hours * 3_600_000), CARRIED, "Append", "ProcessingTime", initialState=earlier
    )
    return decoded.unionByName(carried, allowMissingColumns=True)


def live_features(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``account_id, window_count, window_spend`` of each account as the state of the scoring stream with this checkpoint
    has it: zero where the session has ended, seen from the newest transaction of all.

    Reads the state as of the last committed batch; the stream may run or not.
    """
    state = spark.read.format("statestore").option("stateVarName", "sessions").load(checkpoint)
    sessions = state.selectExpr("user_map_key.account_id", "user_map_value.value.*")
    now = sessions.agg(F.max("last_us")).scalar()
    return sessions.withColumn("open_now", F.col("last_us") >= now - GAP_US).selectExpr(
        "account_id",
        "if(open_now, n, 0L) as window_count",
        f"if(open_now, {from_units('units')}, 0D) as window_spend",
    )
