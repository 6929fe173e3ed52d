"""Detectors of fraud patterns along the time line of an account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import DEFAULT_SKEW, MICROS_PER_SECOND, SkewConfig
from ledgerwatch.functions.columns import floor_to, from_micros, from_units, micros, to_units
from ledgerwatch.functions.rules import RULES_BY_NAME
from ledgerwatch.operators.skew import find_slices
from ledgerwatch.operators.velocity import BY_SLICE, BY_TIME, trailing

GEO_MINUTES = 30
WINDOW_SECONDS = 300
SHOWN = ["transaction_id", "account_id", "event_time", "amount"]


def geo_impossible(
    transactions: DataFrame, minutes: int = GEO_MINUTES, skew: SkewConfig = DEFAULT_SKEW
) -> DataFrame:
    """Transactions in another country than the account's previous one less than ``minutes`` before."""
    rows = transactions.selectExpr("transaction_id", "account_id", "event_time", "country", f"{micros()} as us")
    slices = find_slices(rows.select("account_id", "us", "transaction_id"), skew)
    before = f"lag(struct(us, country)) over ({BY_TIME})"
    sliced = slices.cut(rows)
    if slices.accounts is not None:
        last_of_slice = (
            slices.cut_rows(rows.select("account_id", "us", "transaction_id", "country"))
            .groupBy("account_id", "slice")
            .agg(F.expr("max_by(struct(us, country), struct(us, transaction_id)) as final"))
        )
        carried = last_of_slice.selectExpr("account_id", "slice", f"lag(final) over ({BY_SLICE}) as carried")
        sliced = sliced.join(carried.hint("shuffle_hash"), ["account_id", "slice"], "left")
        before = f"coalesce({before}, carried)"
    steps = sliced.selectExpr("*", f"{before} as previous")
    near = f"us - previous.us < {minutes * 60 * MICROS_PER_SECOND}"
    return steps.where(f"previous.country <> country and {near}").selectExpr(
        "transaction_id",
        "account_id",
        "event_time",
        "country",
        "previous.country as previous_country",
        "(us - previous.us) / 1000000D as seconds_apart",
    )


def card_testing(transactions: DataFrame, min_micro: int = 1, skew: SkewConfig = DEFAULT_SKEW) -> DataFrame:
    """Large amounts that follow at least ``min_micro`` micro amounts within five minutes."""
    micro = RULES_BY_NAME["MICRO_AMOUNT_CARD_TEST"].predicate
    large = RULES_BY_NAME["HIGH_AMOUNT_3K"].predicate
    relevant = transactions.where(f"({micro}) or ({large})")
    counted = trailing(relevant, {"micro_count": f"if({micro}, 1, 0)"}, SHOWN, WINDOW_SECONDS, skew)
    return counted.where(f"{large} and micro_count >= {min_micro}")


def night_owl(transactions: DataFrame, min_amount: float = 200.0) -> DataFrame:
    """Sizeable amounts between two and four at night."""
    return transactions.where(f"hour(event_time) in (2, 3) and amount >= {min_amount}D").select(*SHOWN)


def velocity_abuse(features: DataFrame, more_than: int = 20) -> DataFrame:
    """Transactions beyond the usual number in one session."""
    return features.where(f"window_count > {more_than}").select(
        "transaction_id", "account_id", "event_time", "window_count"
    )


def spend_anomaly(
    transactions: DataFrame, factor: float = 3.0, min_rows: int = 5, skew: SkewConfig = DEFAULT_SKEW
) -> DataFrame:
    """Amounts above ``factor`` times the account's average of the last five minutes."""
    sums = trailing(transactions, {"n": "1", "units": to_units()}, SHOWN, WINDOW_SECONDS, skew)
    averaged = sums.selectExpr(*SHOWN, "n as trailing_count", f"({from_units('units')}) / n as trailing_avg")
    return averaged.where(f"trailing_count >= {min_rows} and amount > {factor}D * trailing_avg")


def device_switching(
    transactions: DataFrame, min_devices: int = 3, length_seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """Accounts that use at least ``min_devices`` devices in one window."""
    start = F.expr(f"{floor_to(micros(), length_seconds * MICROS_PER_SECOND)} as start")
    used = transactions.groupBy(start, "account_id").agg(F.expr("count(distinct device_type) as devices"))
    return used.where(f"devices >= {min_devices}").selectExpr(
        f"{from_micros('start', transactions, 'event_time')} as window_start", "account_id", "devices"
    )
