"""How good and how fast the alerts are, measured on transactions with known truth.

Probes are transactions whose sending time and truth are known:
``transaction_id, sent_at, is_fraud``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import micros, ratio, rounded
from ledgerwatch.operators.percentiles import NEAREST_RANK, nearest_rank
from ledgerwatch.session import checkpointed

# Labels that count as a detection.
DETECTED = "label in ('FRAUD', 'REVIEW')"

LATENCY_MS = f"({micros('detected_at')} - {micros('sent_at')}) / 1000D"

COVERAGE = [
    "count(*) as probes_sent",
    "count_if(alerted) as alerts_received",
    f"{rounded(ratio('count_if(alerted) * 100', 'count(*)'), 1)} as coverage_pct",
]

CONFUSION = [
    "count_if(is_fraud and detected) as true_positives",
    "count_if(not is_fraud and detected) as false_positives",
    "count_if(not is_fraud and not detected) as true_negatives",
    "count_if(is_fraud and not detected) as false_negatives",
]


LATENCY = [
    f"{rounded('avg(latency_ms)', 2)} as latency_mean_ms",
    f"{rounded('coalesce(stddev_samp(latency_ms), 0D)', 2)} as latency_stdev_ms",
]


def first_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per transaction, the earliest: a topic that delivers at least once repeats some."""
    return (
        alerts.groupBy("transaction_id")
        .agg(F.expr("min(struct(detected_at is null as undated, detected_at, label)) as first"))
        .selectExpr("transaction_id", "first.label as label", "first.detected_at as detected_at")
    )


def probe_latency(probes: DataFrame, alerts: DataFrame) -> DataFrame:
    """The alerts raised on probes, with the time from sending to detection."""
    return probes.join(first_alerts(alerts), "transaction_id").selectExpr(
        "transaction_id", "label", "is_fraud", f"{rounded(LATENCY_MS, 3)} as latency_ms"
    )


def probe_outcomes(probes: DataFrame, alerts: DataFrame) -> DataFrame:
    """Every probe, with its first alert if it has one."""
    return probes.join(first_alerts(alerts), "transaction_id", "left").selectExpr(
        "transaction_id",
        "coalesce(is_fraud, false) as is_fraud",
        "label is not null as alerted",
        f"if(label is not null, {rounded(LATENCY_MS, 3)}, null) as latency_ms",
        f"coalesce({DETECTED}, false) as detected",
    )


def coverage(outcomes: DataFrame) -> DataFrame:
    """Coverage of the outcomes of probes, of a table or as a stream has written them."""
    return outcomes.agg(*map(F.expr, COVERAGE))


def probe_coverage(probes: DataFrame, alerts: DataFrame) -> DataFrame:
    return coverage(probe_outcomes(probes, alerts))


def confusion_matrix(probes: DataFrame, alerts: DataFrame) -> DataFrame:
    return probe_outcomes(probes, alerts).agg(*map(F.expr, CONFUSION))


def classifier_report(probes: DataFrame, alerts: DataFrame) -> DataFrame:
    """Coverage, confusion matrix, precision, recall and F1 (from the rounded two) in one row."""
    return _rated(probe_outcomes(probes, alerts).agg(*map(F.expr, COVERAGE + CONFUSION)))


def _rated(counts: DataFrame) -> DataFrame:
    precision = ratio("true_positives", "true_positives + false_positives")
    recall = ratio("true_positives", "true_positives + false_negatives")
    rates = counts.selectExpr("*", f"{rounded(precision, 4)} as precision", f"{rounded(recall, 4)} as recall")
    f1 = "2D * precision * recall / greatest(precision + recall, 0.0001D)"
    return rates.selectExpr("*", f"{rounded(f1, 4)} as f1_score")


def full_report(probes: DataFrame, alerts: DataFrame) -> DataFrame:
    """All figures of a run in one row: coverage, matrix, rates, and the latency's ranks, mean and deviation.

    The outcomes, five narrow columns, are written to the checkpoint folder and read for each part of the report, so
    probes and alerts are read, and transactions scored, once.
    """
    outcomes = checkpointed(probe_outcomes(probes, alerts))
    counts = _rated(outcomes.agg(*map(F.expr, [*COVERAGE, *CONFUSION, *LATENCY])))
    ranks = nearest_rank(outcomes, "latency_ms", NEAREST_RANK, 2)
    named = ranks.selectExpr(*[f"{name} as latency_{name}_ms" for name in ranks.columns], "true as one")
    return counts.selectExpr("*", "true as one").join(named, "one", "left").drop("one")


def latency_nearest_rank(latencies: DataFrame) -> DataFrame:
    return nearest_rank(latencies, "latency_ms", NEAREST_RANK, 2)


def latency_summary(latencies: DataFrame) -> DataFrame:
    """Number, mean and sample standard deviation; the deviation of a single value is zero."""
    return latencies.agg(
        F.expr("count(latency_ms) as n"),
        F.expr(f"{rounded('avg(latency_ms)', 2)} as latency_mean_ms"),
        F.expr(f"{rounded('coalesce(stddev_samp(latency_ms), 0D)', 2)} as latency_stdev_ms"),
    )
