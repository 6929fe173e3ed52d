"""Summaries of a fixed size that are merged: heavy groups and quantiles without a pass over all rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How many times more items than there may be heavy groups a summary follows: a count is then off by less than a
# sixteenth of what makes a group heavy.
FOLLOWED = 64
#: Size of the quantile sketches, whose ranks are then off by about 0.7% of all values (99 times of 100).
QUANTILE_SIZE = 400
RANK_ERROR = 0.01


def followed(share: float) -> int:
    return min(1_000_000, max(1_000, ceil(FOLLOWED / share)))


def group_summary(column: str, share: float) -> str:
    """SQL for the mergeable summary of the values of ``column`` from which groups of ``share`` and more are found."""
    return f"approx_top_k_accumulate({column}, {followed(share)})"


def heavy_candidates(summaries: DataFrame, summary: str, share: float) -> DataFrame:
    """``item, estimate`` of the groups that may have ``share`` of all rows, from any number of ``summaries``."""
    merged = summaries.agg(F.expr(f"approx_top_k_combine({summary}, {followed(share)}) as merged"))
    return merged.selectExpr(f"inline(approx_top_k_estimate(merged, {ceil(2 / share)})) as (item, estimate)")


def heavy_groups(rows: DataFrame, column: str, share: float) -> DataFrame:
    """``column, n`` of all groups with at least ``share`` of the rows of known ``column``, exactly.

    A summary of fixed size names the few groups that can be so large; only these are counted. However many
    groups there are, none but the candidates is shuffled.
    """
    known = rows.select(column).where(f"{column} is not null")
    summary = known.agg(F.expr(f"{group_summary(column, share)} as summary"), F.expr("count(*) as total"))
    named = summary.selectExpr(f"inline(approx_top_k_estimate(summary, {ceil(2 / share)})) as ({column}, estimate)", "total")
    counted = known.join(F.broadcast(named), column).groupBy(column, "total").agg(F.expr("count(*) as n"))
    return counted.where(f"n >= {share}D * total").select(column, "n")


def quantile_summary(value: str) -> str:
    """SQL for the mergeable quantile sketch of a column."""
    return f"kll_sketch_agg_double(cast({value} as double), {QUANTILE_SIZE})"


def quantiles(summaries: DataFrame, summary: str, points: dict[str, float]) -> DataFrame:
    """One row with a column per point and ``n``, the number of values, from any number of sketches; null without values."""
    merged = summaries.where(f"{summary} is not null").agg(
        F.expr(f"kll_merge_agg_double({summary}, {QUANTILE_SIZE}) as merged"), F.expr("count(*) as sketches")
    )
    n = "if(sketches > 0, kll_sketch_get_n_double(merged), 0L)"
    names = [f"if(n > 0, kll_sketch_get_quantile_double(merged, {p}D), null) as {name}" for name, p in points.items()]
    return merged.selectExpr("merged", f"{n} as n").selectExpr(*names, "n")
