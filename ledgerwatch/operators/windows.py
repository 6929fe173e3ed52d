"""Windows over the time line of an account: sliding, tumbling and session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import MICROS_PER_SECOND, SESSION_GAP_SECONDS
from ledgerwatch.functions.columns import exact_sum, floor_to, from_micros, from_units, micros, rounded, to_units

GAP_US = SESSION_GAP_SECONDS * MICROS_PER_SECOND
LENGTH_SECONDS = 300
SLIDE_SECONDS = 60
SKETCH_ERROR = 0.15  # three times the standard error of the sketch


def _per_pane(transactions: DataFrame, slide: int) -> DataFrame:
    """Count, spend and largest amount per account, pane of one slide, merchant and country."""
    timed = transactions.selectExpr(
        "account_id",
        f"{floor_to(micros(), slide)} as pane",
        "merchant_id",
        "country",
        "amount",
        f"{to_units()} as units",
    )
    return timed.groupBy("account_id", "pane", "merchant_id", "country").agg(
        F.expr("count(*) as n"), F.expr("sum(units) as units"), F.expr("max(amount) as largest")
    )


def window_activity(
    transactions: DataFrame, length_seconds: int = LENGTH_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """Activity per account and sliding window, with exact numbers of merchants and countries.

    Rows are combined per pane first. Then every pane enters the windows it is part of, once for its
    merchant and once for its country; one row is left for each name of a window, and these are
    counted. All three steps aggregate before they shuffle and none needs the rows of an account
    together, so an account with all rows, or with a new merchant in each, is spread over all tasks.
    The slide divides the length; equal ones give tumbling windows.
    """
    length, slide = length_seconds * MICROS_PER_SECOND, slide_seconds * MICROS_PER_SECOND
    entries = """inline(array(
        struct(true as is_merchant, merchant_id as name, n as n, units as units, largest as largest),
        struct(false as is_merchant, country as name, null as n, null as units, null as largest)))"""
    named = (
        _per_pane(transactions, slide)
        .selectExpr("account_id", "pane", entries)
        .selectExpr("*", f"explode(sequence(pane - {length - slide}, pane, {slide})) as start")
        .groupBy("account_id", "start", "is_merchant", "name")
        .agg(F.expr("sum(n) as n"), F.expr(f"{exact_sum('units')} as units"), F.expr("max(largest) as largest"))
    )
    activity = named.groupBy("account_id", "start").agg(
        F.expr("sum(n) as n"),
        F.expr(f"{exact_sum('units')} as units"),
        F.expr("count_if(is_merchant and name is not null) as merchants"),
        F.expr("count_if(not is_merchant and name is not null) as countries"),
        F.expr("max(largest) as largest"),
    )
    return _named(activity, transactions, length)


def window_activity_approx(
    transactions: DataFrame, length_seconds: int = LENGTH_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """As ``window_activity`` with sketched distinct numbers: the state of a window has a
    fixed size however many merchants it holds.

    Each pane has one sketch per name column, made once; a window merges the sketches of its panes. Up to some hundred
    names the estimates are exact, beyond that their standard error is 1.6%.
    """
    length, slide = length_seconds * MICROS_PER_SECOND, slide_seconds * MICROS_PER_SECOND
    pane = F.expr(f"{floor_to(micros(), slide)} as pane")
    panes = transactions.groupBy("account_id", pane).agg(
        F.expr("count(*) as n"),
        F.expr(f"sum({to_units()}) as units"),
        F.expr("hll_sketch_agg(merchant_id) as merchants"),
        F.expr("hll_sketch_agg(country) as countries"),
        F.expr("max(amount) as largest"),
    )
    spread = panes.selectExpr("*", f"explode(sequence(pane - {length - slide}, pane, {slide})) as start")
    activity = spread.groupBy("account_id", "start").agg(
        F.expr("sum(n) as n"),
        F.expr(f"{exact_sum('units')} as units"),
        F.expr("hll_sketch_estimate(hll_union_agg(merchants)) as merchants"),
        F.expr("hll_sketch_estimate(hll_union_agg(countries)) as countries"),
        F.expr("max(largest) as largest"),
    )
    return _named(activity, transactions, length)


def sketch_errors(
    transactions: DataFrame, length_seconds: int = LENGTH_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """Per account and window the exact figures, and whether the sketched distinct numbers are within
    ``SKETCH_ERROR`` of them.
    """
    exact = window_activity(transactions, length_seconds, slide_seconds)
    sketched = window_activity_approx(transactions, length_seconds, slide_seconds)
    keys, names = ["window_start", "account_id"], ["window_distinct_merchants", "window_distinct_countries"]
    near = [f"abs({n} - sketched_{n}) <= {SKETCH_ERROR}D * {n} + 1 as {n}_near" for n in names]
    renamed = sketched.selectExpr(*keys, "window_txn_count as sketched_count", *[f"{n} as sketched_{n}" for n in names])
    return exact.join(renamed, keys, "full").selectExpr(
        *keys, "window_txn_count", "sketched_count = window_txn_count as same_count", *names, *near
    )


def _named(activity: DataFrame, transactions: DataFrame, length: int) -> DataFrame:
    spend = from_units("units")
    return activity.selectExpr(
        f"{from_micros('start', transactions, 'event_time')} as window_start",
        f"{from_micros(f'start + {length}', transactions, 'event_time')} as window_end",
        "account_id",
        "n as window_txn_count",
        f"{spend} as window_total_spend",
        "merchants as window_distinct_merchants",
        "countries as window_distinct_countries",
        "largest as window_max_amount",
        f"{rounded(f'{spend} / n', 6)} as window_avg_amount",
    )


def account_sessions(transactions: DataFrame) -> DataFrame:
    """One row per account and session: start, last transaction, count and spend.

    Rows are first combined in cells no longer than the session gap, inside which no
    session ends, so an account has a number of cells that its time span limits.
    """
    timed = transactions.selectExpr("account_id", f"{micros()} as us", f"{to_units()} as units")
    cells = timed.groupBy("account_id", F.expr(f"{floor_to('us', GAP_US)} as cell")).agg(
        F.expr("min(us) as first_us"),
        F.expr("max(us) as last_us"),
        F.expr("count(*) as n"),
        F.expr("sum(units) as units"),
    )
    by_cell = "partition by account_id order by cell"
    paused = cells.selectExpr("*", f"first_us - lag(last_us) over ({by_cell}) > {GAP_US} as paused")
    numbered = paused.selectExpr("*", f"count_if(paused) over ({by_cell}) as session")
    sessions = numbered.groupBy("account_id", "session").agg(
        F.expr("min(first_us) as first_us"),
        F.expr("max(last_us) as last_us"),
        F.expr("sum(n) as n"),
        F.expr("sum(units) as units"),
    )
    return sessions.selectExpr(
        "account_id",
        f"{from_micros('first_us', transactions, 'event_time')} as session_start",
        f"{from_micros('last_us', transactions, 'event_time')} as session_last",
        "n as session_count",
        f"{from_units('units')} as session_spend",
    )


def account_features(transactions: DataFrame) -> DataFrame:
    """Count and spend of each account's session that is open at the newest transaction of
    all; zero where the last session has already ended."""
    last = account_sessions(transactions).groupBy("account_id").agg(
        F.expr("max_by(struct(session_count, session_spend), session_start) as last"),
        F.expr("max(session_last) as last_seen"),
    )
    now = transactions.agg(F.max("event_time")).scalar()
    open_now = F.expr(micros("last_seen")) >= F.unix_micros(now.cast("timestamp")) - GAP_US
    return last.withColumn("open_now", open_now).selectExpr(
        "account_id",
        "if(open_now, last.session_count, 0L) as window_count",
        "if(open_now, last.session_spend, 0D) as window_spend",
    )
