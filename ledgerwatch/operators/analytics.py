"""Figures over alerts and scores: totals, top groups, histograms and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import ALERT_THRESHOLD, LATENCY_BOUNDS_MS, SCORE_BOUNDS, TOP_GROUPS, TOP_RULES
from ledgerwatch.functions.columns import exact_sum, floor_to, from_micros, from_units, micros, ratio, rounded, to_units


def _mean(value: str, places: int) -> str:
    """Mean of values with up to four decimals, from an exact sum."""
    return rounded(f"({from_units(exact_sum(to_units(value)))}) / count({value})", places)


def _aggregate(rows: DataFrame, *measures: str) -> DataFrame:
    return rows.agg(*[F.expr(m) for m in measures])


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Numbers and shares of fraud and review alerts, mean score and mean latency."""
    fraud, review = "count_if(label = 'FRAUD')", "count_if(label = 'REVIEW')"
    return _aggregate(
        alerts,
        "count(*) as alerts",
        f"{fraud} as fraud_alerts",
        f"{review} as review_alerts",
        f"{rounded(ratio(f'{fraud} * 100', 'count(*)'), 1)} as fraud_pct",
        f"{rounded(ratio(f'{review} * 100', 'count(*)'), 1)} as review_pct",
        f"{_mean('fraud_score', 3)} as avg_score",
        f"{_mean('detection_latency_ms', 2)} as avg_latency_ms",
    )


def score_histogram(alerts: DataFrame, bins: int = 20) -> DataFrame:
    """Alerts per score bin, empty ones too; equal bins on [0, 1], the last one closed."""
    number = f"least(floor(fraud_score * {bins}), {bins - 1})"
    counts = [f"struct({k} as bin, {k / bins}D as bin_start, count_if({number} = {k}) as alerts)" for k in range(bins)]
    return _aggregate(alerts, f"array({', '.join(counts)}) as bins").selectExpr("inline(bins)")


def cumulative_buckets(values: DataFrame, value: str, bounds: list[float], places: int) -> DataFrame:
    """For each bound and for no bound: the number of values up to it, with overall sum and count.

    One pass over the data; the row per bound is made from the single row of totals.
    """
    totals = _aggregate(
        values,
        *[f"count_if({value} <= {bound}D) as le_{i}" for i, bound in enumerate(bounds)],
        f"count({value}) as value_count",
        f"sum(cast({value} as decimal(30,12))) as exact_sum",
    )
    rows = [f"struct('{bound:g}' as le, le_{i} as cumulative)" for i, bound in enumerate(bounds)]
    rows.append("struct('+Inf' as le, value_count as cumulative)")
    return totals.selectExpr(
        f"inline(array({', '.join(rows)}))",
        f"coalesce(cast(round(exact_sum, {places}) as double), 0D) as value_sum",
        "value_count",
    )


def score_buckets(scored: DataFrame) -> DataFrame:
    return cumulative_buckets(scored, "fraud_score", SCORE_BOUNDS, 4)


def latency_buckets(rows: DataFrame, column: str = "latency_ms") -> DataFrame:
    return cumulative_buckets(rows, column, LATENCY_BOUNDS_MS, 2)


def pipeline_counters(scored: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    return _aggregate(
        scored,
        "count(*) as transactions_processed",
        f"count_if(fraud_score >= {threshold}D) as alerts_emitted",
    )


def throughput(transactions: DataFrame) -> DataFrame:
    """Transactions per second over their time span, which counts as at least a millisecond."""
    seconds = f"({micros('max(event_time)')} - {micros('min(event_time)')}) / 1000000D"
    return _aggregate(
        transactions,
        "count(*) as transactions",
        f"{rounded(f'count(*) / greatest({seconds}, 0.001D)', 4)} as per_second",
    )


def throughput_per_second(transactions: DataFrame) -> DataFrame:
    """Transactions in each second that has any."""
    second = F.expr(f"{floor_to(micros(), 1_000_000)} as us")
    counts = transactions.groupBy(second).agg(F.expr("count(*) as transactions"))
    return counts.selectExpr(f"{from_micros('us', transactions, 'event_time')} as second", "transactions")


def alerts_over_time(alerts: DataFrame, seconds: int = 5) -> DataFrame:
    """Alerts per bin from the first to the last bin that has any; empty bins count zero.

    The bins are laid out day by day on several executors, so a long time span does not
    have to fit into one task.
    """
    width, day = seconds * 1_000_000, 86_400_000_000
    # The counts are used twice. For Spark to compute them once, both uses must need the same
    # columns and have the same filters: the bin is never null, and says so.
    bin_us = F.expr(f"coalesce({floor_to(micros('detected_at'), width)}, 0L) as bin")
    counted = alerts.where("detected_at is not null").groupBy(bin_us).agg(F.expr("count(*) as n"))
    ends = _aggregate(counted, "min(bin) as first", "max(bin) as last", "sum(n) as total").where("total > 0")
    days = ends.selectExpr(
        "first", "last", f"explode(sequence({floor_to('first', day)}, {floor_to('last', day)}, {day})) as day"
    )
    tasks = int(alerts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bins = days.repartition(tasks, "day").selectExpr(
        f"explode(sequence(greatest(first, day), least(last, day + {day - width}), {width})) as bin"
    )
    return bins.join(counted, "bin", "left").selectExpr(
        f"{from_micros('bin', alerts, 'detected_at')} as bin_start", "coalesce(n, 0L) as alerts"
    )


def top_groups(alerts: DataFrame, column: str, limit: int = TOP_GROUPS) -> DataFrame:
    """The groups with most alerts; equal numbers in order of the name."""
    counts = alerts.where(f"{column} is not null").groupBy(column).agg(F.expr("count(*) as alerts"))
    return counts.orderBy(F.desc("alerts"), column).limit(limit)


# One row per fired rule, by its name without the detail after the colon.
RULE_NAMES = "explode(transform(rules_triggered, rule -> substring_index(rule, ':', 1))) as rule"


def rule_frequency(alerts: DataFrame, limit: int = TOP_RULES) -> DataFrame:
    return top_groups(alerts.selectExpr(RULE_NAMES), "rule", limit)


def rule_precision(alerts: DataFrame) -> DataFrame:
    """Per rule: the alerts it took part in and the share of them that are true fraud."""
    true_fraud = "count_if(is_fraud_ground_truth)"
    return (
        alerts.selectExpr(RULE_NAMES, "is_fraud_ground_truth")
        .groupBy("rule")
        .agg(
            F.expr("count(*) as alerts"),
            F.expr(f"{true_fraud} as true_fraud"),
            F.expr(f"{rounded(ratio(true_fraud, 'count(*)'), 4)} as precision"),
        )
    )
