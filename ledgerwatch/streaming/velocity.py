"""Streams of account activity per window, and of account sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.config import SESSION_GAP_SECONDS, WATERMARK, WINDOW_LENGTH, WINDOW_SLIDE
from ledgerwatch.functions.columns import exact_sum, from_units, rounded, to_units
from ledgerwatch.session import checkpoint_root


def _flat(windows: DataFrame) -> DataFrame:
    spend = from_units("units")
    return windows.selectExpr(
        "window.start as window_start",
        "window.end as window_end",
        "account_id",
        "n as window_txn_count",
        f"{spend} as window_total_spend",
        "merchants as window_distinct_merchants",
        "countries as window_distinct_countries",
        "largest as window_max_amount",
        f"{rounded(f'{spend} / n', 6)} as window_avg_amount",
    )


def window_stream(
    transactions: DataFrame, late: str = WATERMARK, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """Activity per account and sliding window, for append mode, with exact distinct numbers. A slide
    as long as the window gives tumbling windows.

    A distinct aggregate cannot run on a stream, and a set per window would hold all merchants of a
    busy account in one row. So transactions are first combined per pane of one slide, account,
    merchant and country, which is the only state that grows with them. Closed panes enter their
    windows once for their merchant and once for their country; one row is kept for each name of a
    window, spread over the tasks, and the last aggregation counts these rows.
    """
    pane = F.window("event_time", slide).alias("pane")
    panes = (
        transactions.withWatermark("event_time", late)
        .groupBy(pane, "account_id", "merchant_id", "country")
        .agg(F.expr("count(*) as n"), F.expr(f"sum({to_units()}) as units"), F.expr("max(amount) as largest"))
    )
    entries = """inline(array(
        struct('merchant' as kind, merchant_id as name, n as n, units as units, largest as largest),
        struct('country' as kind, country as name, 0L as n, null as units, null as largest)))"""
    entered = panes.select("pane", "account_id", F.expr(entries).alias("kind", "name", "n", "units", "largest"))
    window = F.window("pane", length, slide).alias("window")
    named = entered.groupBy(window, "account_id", "kind", "name").agg(
        F.expr("sum(n) as n"), F.expr(f"{exact_sum('units')} as units"), F.expr("max(largest) as largest")
    )
    windows = named.groupBy("window", "account_id").agg(
        F.expr("sum(n) as n"),
        F.expr(f"{exact_sum('units')} as units"),
        F.expr("count_if(kind = 'merchant' and name is not null) as merchants"),
        F.expr("count_if(kind = 'country' and name is not null) as countries"),
        F.expr("max(largest) as largest"),
    )
    return _flat(windows)


def window_monitor(
    transactions: DataFrame, late: str = WATERMARK, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """The same for update mode, with sketched distinct numbers of a fixed size."""
    window = F.window("event_time", length, slide).alias("window")
    windows = (
        transactions.withWatermark("event_time", late)
        .groupBy(window, "account_id")
        .agg(
            F.expr("count(*) as n"),
            F.expr(f"sum({to_units()}) as units"),
            F.expr("approx_count_distinct(merchant_id) as merchants"),
            F.expr("approx_count_distinct(country) as countries"),
            F.expr("max(amount) as largest"),
        )
    )
    return _flat(windows)


def session_stream(transactions: DataFrame, late: str = WATERMARK) -> DataFrame:
    """Sessions of each account as they close, for append mode."""
    session = F.session_window("event_time", f"{SESSION_GAP_SECONDS} seconds").alias("session")
    closed = (
        transactions.withWatermark("event_time", late)
        .groupBy(session, "account_id")
        .agg(
            F.expr("max(event_time) as session_last"),
            F.expr("count(*) as session_count"),
            F.expr(f"sum({to_units()}) as units"),
        )
    )
    return closed.selectExpr(
        "account_id",
        "session.start as session_start",
        "session_last",
        "session_count",
        f"{from_units('units')} as session_spend",
    )


def start_table(
    rows: DataFrame, path: str, name: str, checkpoint: str | None = None, every: str = "30 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Append the closed windows or sessions to a table of files."""
    folder = checkpoint or f"{checkpoint_root(rows.sparkSession)}/{name}"
    writer = rows.writeStream.queryName(name).outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", folder).option("path", path)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def start_monitor(
    rows: DataFrame, sink: str = "console", name: str = "ledgerwatch_windows", checkpoint: str | None = None,
    every: str = "30 seconds", available_now: bool = False, mode: str = "update",
) -> StreamingQuery:
    """Show changing windows, five rows per batch; running totals are shown in ``complete`` mode."""
    folder = checkpoint or f"{checkpoint_root(rows.sparkSession)}/{name}"
    writer = rows.writeStream.queryName(name).outputMode(mode).format(sink)
    if sink == "console":
        writer = writer.option("truncate", False).option("numRows", 5)
    writer = writer.option("checkpointLocation", folder)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()
