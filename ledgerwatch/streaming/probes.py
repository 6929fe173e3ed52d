"""Probe and alert streams joined while they run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import WATERMARK
from ledgerwatch.functions.columns import rounded
from ledgerwatch.operators.quality import DETECTED, LATENCY_MS


def alerts_once(alerts: DataFrame, late: str = WATERMARK) -> DataFrame:
    """Each alert once, of a table or a stream: a topic that delivers at least once repeats some.

    The id of an alert follows from its transaction, so a batch that is scored and published again after a failure
    repeats the same ids. A stream remembers ids as long as the watermark, which follows ``detected_at``, is ``late``
    behind; repeats within that are left out.
    """
    if not alerts.isStreaming:
        return alerts.dropDuplicates(["alert_id"])
    return alerts.withWatermark("detected_at", late).dropDuplicatesWithinWatermark(["alert_id"])


def _matched(probes: DataFrame, alerts: DataFrame, within: str, late: str, how: str) -> DataFrame:
    sent = probes.select("transaction_id", "sent_at", "is_fraud").withWatermark("sent_at", late)
    raised = (
        alerts.select(F.col("transaction_id").alias("alerted_id"), "label", "detected_at")
        .withWatermark("detected_at", late)
        .dropDuplicatesWithinWatermark(["alerted_id"])
    )
    matches = f"""transaction_id = alerted_id and detected_at >= sent_at
        and detected_at <= sent_at + interval {within}"""
    return sent.join(raised, F.expr(matches), how)


def probe_latency_stream(
    probes: DataFrame, alerts: DataFrame, within: str = "60 seconds", late: str = WATERMARK
) -> DataFrame:
    """Alerts on probes that arrive ``within`` the time after sending; both are streams.

    The time bound lets Spark forget probes that no alert can reach any more. Of the alerts on one transaction
    that come within the watermark, the first to arrive counts.
    """
    return _matched(probes, alerts, within, late, "inner").selectExpr(
        "transaction_id", "label", "is_fraud", f"{LATENCY_MS} as latency_ms"
    )


def probe_outcomes_stream(
    probes: DataFrame, alerts: DataFrame, within: str = "60 seconds", late: str = WATERMARK
) -> DataFrame:
    """Every probe once, with its alert or, when none can come any more, without.

    The columns are those of ``operators.quality.probe_outcomes``; their table gives the live coverage and matrix.
    """
    return _matched(probes, alerts, within, late, "left_outer").selectExpr(
        "transaction_id",
        "coalesce(is_fraud, false) as is_fraud",
        "label is not null as alerted",
        f"if(label is not null, {rounded(LATENCY_MS, 3)}, null) as latency_ms",
        f"coalesce({DETECTED}, false) as detected",
    )
