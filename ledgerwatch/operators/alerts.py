"""Alerts from scored transactions, and the views kept over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import (
    ALERT_THRESHOLD,
    FEED_ROWS,
    FEED_RULES,
    FEED_SIZE,
    HISTORY_HOURS,
    HISTORY_PER_ACCOUNT,
    RECENT_ALERTS,
)
from ledgerwatch.functions.columns import exact_sum, from_units, rounded, to_units
from ledgerwatch.functions.scores import LABEL


def raise_alerts(
    scored: DataFrame, latency_ms: str, detected_at: str, threshold: float = ALERT_THRESHOLD
) -> DataFrame:
    """The scored rows at or above the threshold, as alerts.

    ``latency_ms`` and ``detected_at`` are expressions over the scored rows. The unrounded
    score decides; the alert shows it with four decimals. The id follows from the
    transaction, so a replay raises the same alert again and not another one.
    """
    return scored.where(f"fraud_score >= {threshold}D").selectExpr(
        "sha2(transaction_id, 256) as alert_id",
        "transaction_id",
        "account_id",
        "coalesce(merchant_category, '') as merchant_category",
        "amount",
        "coalesce(country, '') as country",
        f"{rounded('fraud_score', 4)} as fraud_score",
        f"{LABEL} as label",
        "rules_triggered",
        f"{rounded(latency_ms, 2)} as detection_latency_ms",
        f"{detected_at} as detected_at",
        "coalesce(is_fraud, false) as is_fraud_ground_truth",
    )


def account_history(
    alerts: DataFrame, as_of: Column, keep: int = HISTORY_PER_ACCOUNT, hours: int = HISTORY_HOURS
) -> DataFrame:
    """The newest alerts of each account, for accounts with an alert in the last ``hours``.

    The rank filter runs before the shuffle too, so an account sends at most ``keep`` rows
    from each input partition.
    """
    rank = "row_number() over (partition by account_id order by detected_at desc, transaction_id)"
    newest = alerts.selectExpr("*", f"{rank} as position").where(f"position <= {keep}")
    dated = newest.selectExpr("*", "max(detected_at) over (partition by account_id) as last_alert")
    return dated.where(F.col("last_alert") > as_of - F.expr(f"interval {hours} hours")).drop("last_alert")


def newest_alerts(alerts: DataFrame, limit: int) -> DataFrame:
    return alerts.orderBy(F.desc("detected_at"), "transaction_id").limit(limit)


def live_feed(alerts: DataFrame) -> DataFrame:
    return newest_alerts(alerts, FEED_SIZE)


def recent_alerts(alerts: DataFrame) -> DataFrame:
    return newest_alerts(alerts, RECENT_ALERTS)


def feed_rows(alerts: DataFrame) -> DataFrame:
    """The first rows of the feed as they are shown, with defaults for missing values."""
    return newest_alerts(alerts, FEED_ROWS).selectExpr(
        "transaction_id",
        "coalesce(label, 'REVIEW') as label",
        "format_string('%.3f', coalesce(fraud_score, 0D)) as score",
        "concat('$', format_number(coalesce(amount, 0D), 2)) as amount",
        "coalesce(account_id, '') as account_id",
        "concat(coalesce(merchant_category, ''), ' / ', coalesce(country, '')) as place",
        "cast(bround(coalesce(detection_latency_ms, 0D), 0) as bigint) as latency_ms",
        f"array_join(slice(rules_triggered, 1, {FEED_RULES}), ', ') as rules",
        "substring(date_format(detected_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 1, 19) as detected",
    )


def global_stats(alerts: DataFrame) -> DataFrame:
    """Number of alerts and the amount they flag; zero without alerts."""
    flagged = from_units(f"coalesce({exact_sum(to_units())}, 0)")
    return alerts.agg(F.expr("count(*) as total_alerts"), F.expr(f"{flagged} as total_amount_flagged"))
