"""Velocity and composite scores over a frame that has ``window_count`` and ``window_spend``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerwatch.config import FRAUD_THRESHOLD
from ledgerwatch.functions.rules import FIRED_RULES, RULE_SCORE

# Where the velocity scores start, how fast they rise and where they end.
FAST = "window_count > 20"
FAST_POINTS = "least((window_count - 20) / 30D, 0.40D)"
LAVISH = "window_spend > 5000D"
LAVISH_POINTS = "least((window_spend - 5000D) / 10000D, 0.30D)"

VELOCITY_SCORE = (
    f"case when {FAST} then {FAST_POINTS} else 0D end + case when {LAVISH} then {LAVISH_POINTS} else 0D end"
)
# Whole spend is rounded half to even.
FIRED_VELOCITY = f"""array_compact(array(
    case when {FAST} then concat('VELOCITY_COUNT:', cast(window_count as string)) end,
    case when {LAVISH} then concat('VELOCITY_SPEND:', cast(cast(bround(window_spend, 0) as bigint) as string)) end))"""

LABEL = f"case when fraud_score >= {FRAUD_THRESHOLD}D then 'FRAUD' else 'REVIEW' end"


def score_transactions(features: DataFrame) -> DataFrame:
    """Add rule, velocity and composite scores and the list of everything that fired."""
    return features.selectExpr(
        "*",
        f"{RULE_SCORE} as rule_score",
        f"{VELOCITY_SCORE} as velocity_score",
        "least(rule_score + velocity_score, 1D) as fraud_score",
        f"concat({FIRED_RULES}, {FIRED_VELOCITY}) as rules_triggered",
    )
