"""Running activity of an account: session counters and trailing five minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import DEFAULT_SKEW, MICROS_PER_SECOND, SESSION_GAP_SECONDS, SkewConfig
from ledgerwatch.functions.columns import TOTAL, exact_sum, from_units, micros, to_units
from ledgerwatch.operators.skew import Slices, find_slices

GAP_US = SESSION_GAP_SECONDS * MICROS_PER_SECOND

BY_TIME = "partition by account_id, slice order by us, transaction_id"
BY_SLICE = "partition by account_id order by slice"
UP_TO_ROW = "rows between unbounded preceding and current row"
BEFORE_ROW = "rows between unbounded preceding and 1 preceding"


def session_velocity(
    transactions: DataFrame, skew: SkewConfig | None = DEFAULT_SKEW, earlier: DataFrame | None = None
) -> DataFrame:
    """Add ``window_count`` and ``window_spend``: count and spend of the account's current
    session up to and including the row, in order of event time and transaction id.

    A session ends when the account pauses for more than 300 seconds. Without ``skew`` no account
    is cut, which suits a table that is known to be small. ``earlier``, for such a table, has the sessions that were
    open before (``account_id, carried_n, carried_units, carried_last_us``); a row older than that counts in it.
    """
    rows = transactions.selectExpr("*", f"{micros()} as us", f"{to_units()} as units")
    keys = rows.select("account_id", "us", "transaction_id", "units")
    slices = find_slices(keys, None if earlier is not None else skew)
    sliced = slices.cut(rows)
    if earlier is not None:
        sliced = sliced.join(earlier.hint("shuffle_hash"), "account_id", "left")
    elif slices.accounts is None:
        kinds = {"carried_n": "bigint", "carried_units": TOTAL, "carried_last_us": "bigint"}
        sliced = sliced.selectExpr("*", *[f"cast(null as {kind}) as {name}" for name, kind in kinds.items()])
    else:
        # A shuffled hash join leaves the rows partitioned for the windows and unsorted
        # until the windows sort them, once.
        carried = _open_before(slices.cut_rows(keys))
        sliced = sliced.join(carried.hint("shuffle_hash"), ["account_id", "slice"], "left")
    totals = _running(sliced)
    # What to take off the totals: all that came before the session began in this slice,
    # or, if it began earlier, nothing, and the open session of earlier slices comes on top.
    began = f"""case when us - greatest(previous_us, carried_last_us) > {GAP_US}
        then struct(total_n - 1 as n, total_units - units as units) end"""
    return totals.selectExpr("*", f"last({began}, true) over ({BY_TIME} {UP_TO_ROW}) as began").selectExpr(
        *transactions.columns,
        "cast(total_n - coalesce(began.n, -carried_n, 0) as bigint) as window_count",
        f"{from_units('(total_units - coalesce(began.units, -carried_units, 0))')} as window_spend",
    )


def _running(sliced: DataFrame) -> DataFrame:
    return sliced.selectExpr(
        "*",
        f"lag(us) over ({BY_TIME}) as previous_us",
        f"row_number() over ({BY_TIME}) as total_n",
        f"sum(units) over ({BY_TIME} {UP_TO_ROW}) as total_units",
    )


def _open_before(rows: DataFrame) -> DataFrame:
    """Per slice: the session that was open before it began, and the time of the row before.

    What a slice hands on is one row: what it counts since the last pause inside it, or all of it on top of
    what it was handed, if it has no pause inside and none in front.
    """
    pause = f"us - previous_us > {GAP_US}"
    summary = (
        _running(rows)
        .groupBy("account_id", "slice")
        .agg(
            F.expr("count(*) as n"),
            F.expr(f"{exact_sum('units')} as units"),
            F.expr("min(us) as first_us"),
            F.expr("max(us) as last_us"),
            F.expr(
                f"max_by(struct(total_n - 1 as n, cast(total_units - units as {TOTAL}) as units), total_n) "
                f"filter (where {pause}) as inside"
            ),
        )
    )
    totals = summary.selectExpr(
        "*",
        f"max(last_us) over ({BY_SLICE} {BEFORE_ROW}) as known_us",
        f"coalesce(sum(n) over ({BY_SLICE} {BEFORE_ROW}), 0) as before_n",
        f"cast(coalesce({exact_sum('units')} over ({BY_SLICE} {BEFORE_ROW}), 0) as {TOTAL}) as before_units",
    )
    began = f"""case when inside is not null
            then struct(before_n + inside.n as n, cast(before_units + inside.units as {TOTAL}) as units)
        when first_us - known_us > {GAP_US} then struct(before_n as n, before_units as units) end"""
    open_sessions = totals.selectExpr("*", f"last({began}, true) over ({BY_SLICE} {UP_TO_ROW}) as began")
    return open_sessions.selectExpr(
        "account_id",
        "slice",
        f"lag(before_n + n - coalesce(began.n, 0)) over ({BY_SLICE}) as carried_n",
        f"lag(cast(before_units + units - coalesce(began.units, 0) as {TOTAL})) over ({BY_SLICE}) as carried_units",
        "known_us as carried_last_us",
    ).where("carried_n is not null")


def open_sessions(scored: DataFrame) -> DataFrame:
    """``account_id, n, units, last_us``: each account's last session in a scored table, as a stream that is
    started from the table continues it.
    """
    last = f"struct({micros()} as us, transaction_id)"
    session = f"struct(window_count as n, cast({to_units('window_spend')} as {TOTAL}) as units)"
    newest = scored.groupBy("account_id").agg(
        F.expr(f"max_by({session}, {last}) as session"), F.expr(f"max({micros()}) as last_us")
    )
    return newest.select("account_id", "session.n", "session.units", "last_us")


def running_change(events: DataFrame, measures: list[str], slices: Slices) -> DataFrame:
    """Replace each measure by its sum over the account's events up to the same time, all events of that time
    included.

    ``events`` has ``account_id``, ``us``, the tie of ``slices`` and the measures, integers or decimals.
    """
    so_far = "partition by account_id, slice order by us range between unbounded preceding and current row"
    sliced = slices.cut(events)
    others = [name for name in events.columns if name not in measures]
    if slices.accounts is None:
        return sliced.selectExpr(*others, *[f"sum({m}) over ({so_far}) as {m}" for m in measures])
    carried = _sums_around(slices.cut_rows(events.selectExpr("account_id", "us", slices.tie, *measures)), measures)
    joined = sliced.join(carried.hint("shuffle_hash"), ["account_id", "slice"], "left")
    return joined.selectExpr(
        *others,
        *[
            f"sum({m}) over ({so_far}) + coalesce(carried_{m}, 0) + if(us = last_us, tail_{m}, 0) as {m}"
            for m in measures
        ],
    )


def _sums_around(rows: DataFrame, measures: list[str]) -> DataFrame:
    """Per slice: the sums of the slices before, and of the events in later slices that have the time of the
    slice's last one (``tail_...``), as ties may be cut.
    """
    times = rows.groupBy("account_id", "slice", "us").agg(*[F.expr(f"sum({m}) as {m}") for m in measures])
    summary = times.groupBy("account_id", "slice").agg(
        F.expr("min(us) as first_us"),
        F.expr("max(us) as last_us"),
        *[F.expr(f"sum({m}) as {m}") for m in measures],
        *[F.expr(f"min_by({m}, us) as head_{m}") for m in measures],
    )
    # All heads of one time, and those up to the slice; slices of one time follow each other.
    same = "partition by account_id, first_us"
    heads = summary.selectExpr(
        "*",
        *[f"sum(head_{m}) over ({same}) as heads_{m}" for m in measures],
        *[f"sum(head_{m}) over ({same} order by slice {UP_TO_ROW}) as passed_{m}" for m in measures],
    )
    return heads.selectExpr(
        "account_id",
        "slice",
        "last_us",
        *[f"sum({m}) over ({BY_SLICE} {BEFORE_ROW}) as carried_{m}" for m in measures],
        *[
            f"""case when first_us = last_us then heads_{m} - passed_{m}
            when lead(first_us) over ({BY_SLICE}) = last_us then lead(heads_{m}) over ({BY_SLICE}) else 0 end as tail_{m}"""
            for m in measures
        ],
    )


def trailing(
    rows: DataFrame,
    measures: dict[str, str],
    keep: list[str],
    seconds: int = SESSION_GAP_SECONDS,
    skew: SkewConfig | None = DEFAULT_SKEW,
) -> DataFrame:
    """The ``keep`` columns and the sums of integer or decimal ``measures`` over the account's last
    ``seconds``, both ends included.

    Every row enters the sums at its time and leaves them just after ``seconds``, so the
    windows are running sums, whose cost does not grow with the rows in a window.
    """
    timed = rows.selectExpr("*", f"{micros()} as us")
    payload = f"struct({', '.join(keep)})"
    enter = ", ".join(["us as us", *[f"{v} as {m}" for m, v in measures.items()]])
    leave = ", ".join(
        [
            f"us + {seconds * MICROS_PER_SECOND + 1} as us",
            *[f"-({v}) as {m}" for m, v in measures.items()],
        ]
    )
    events = timed.selectExpr(
        "account_id",
        "transaction_id",
        f"inline(array(struct({enter}, {payload} as payload), struct({leave}, if(false, {payload}, null) as payload)))",
    )
    slices = find_slices(events.select("account_id", "us", "transaction_id"), skew)
    summed = running_change(events, list(measures), slices)
    return summed.where("payload is not null").select("payload.*", *measures)


def trailing_velocity(transactions: DataFrame, skew: SkewConfig = DEFAULT_SKEW) -> DataFrame:
    """Count and spend of the account over the last five minutes, ends included."""
    keep = ["transaction_id", "account_id", "event_time", "amount"]
    sums = trailing(transactions, {"window_count": "1", "window_units": to_units()}, keep, skew=skew)
    return sums.selectExpr(*keep, "window_count", f"{from_units('window_units')} as window_spend")
