"""Exact percentiles that do not bring the values into one task.

Values are counted per distinct value, the counts are added up per bucket, and the ranks
are located among the buckets. Only the buckets that hold a wanted rank are looked into.
A bucket spans 0.1% of the size of its values, also of the smallest; there are at most three million
buckets over the whole range of doubles. The range of a bucket that is hit is divided into cells, and the cell that
is hit once more, so that ten million distinct values in a bucket leave one or a few to be sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import rounded

BUCKETS_PER_E = 1024
# Into so many cells a range is divided, so many times.
CELLS = 4096
ROUNDS = 2

# The percentiles of the two reports.
INTERPOLATED = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
NEAREST_RANK = {"p50": 50.0, "p90": 90.0, "p99": 99.0, "p999": 99.9}

# A whole number that never falls when the value rises. It is never null, and says so: a
# null check on one use of the counted values would keep the other use from sharing them.
# Zero has a bucket of its own; NaN comes after all numbers, as Spark sorts it. The logarithm of the smallest double is -745.
SIZE = f"floor((ln(least(abs(value), 1.7976931348623157E308D)) + 746D) * {BUCKETS_PER_E}) + 1"
BUCKET = f"""coalesce(case when isnan(value) then {2**40}L when value > 0 then {SIZE}
    when value < 0 then -({SIZE}) end, 0L)"""


def order_statistics(values: DataFrame, value: str, ranks: dict[str, str]) -> DataFrame:
    """``(name, value, total, mean)`` for zero-based ``ranks`` in ascending order.

    A rank is an expression over ``total``, the number of values that are not null; ``mean``
    is the mean of them all.
    """
    counted = (
        values.selectExpr(f"cast({value} as double) as value")
        .where("value is not null")
        .groupBy("value")
        .agg(F.expr("count(*) as n"))
        .selectExpr("value", "n", f"{BUCKET} as bucket")
    )
    buckets = counted.groupBy("bucket").agg(
        F.expr("sum(n) as in_bucket"),
        F.expr("sum(value * n) as bucket_sum"),
        F.expr("min(value) as low"),
        F.expr("max(value) as high"),
    )
    wanted = ", ".join(f"struct('{name}' as name, cast({rank} as bigint) as rank)" for name, rank in ranks.items())
    # ``located`` has one row per wanted rank.
    located = (
        buckets.selectExpr(
            "bucket",
            "in_bucket",
            "low",
            "high",
            "coalesce(sum(in_bucket) over (order by bucket rows between unbounded preceding and 1 preceding), 0) as below",
            "sum(in_bucket) over (order by bucket rows between unbounded preceding and unbounded following) as total",
            "sum(bucket_sum) over (order by bucket rows between unbounded preceding and unbounded following) as value_sum",
        )
        .selectExpr("bucket", "in_bucket", "low", "high", "below", "total", "value_sum", f"inline(array({wanted}))")
        .where("rank >= below and rank < below + in_bucket")
        .drop("in_bucket")
    )
    for _ in range(ROUNDS):
        located = narrowed(counted, located)
    up_to = "partition by name order by value rows between unbounded preceding and current row"
    return (
        _inside(counted, located)
        .selectExpr("*", f"below + sum(n) over ({up_to}) as reached")
        .where("reached > rank and reached - n <= rank")
        .selectExpr("name", "value", "total", "value_sum / total as mean")
    )


def _inside(counted: DataFrame, located: DataFrame) -> DataFrame:
    """The values that lie where a rank was located."""
    return counted.join(F.broadcast(located), "bucket").where("value >= low and value <= high")


def narrowed(counted: DataFrame, located: DataFrame) -> DataFrame:
    """``located`` with a smaller range for each rank: the cell of its range that holds the rank."""
    cell = f"if(high > low, least(cast((value - low) / (high - low) * {CELLS} as int), {CELLS - 1}), 0) as cell"
    kept = ["name", "rank", "bucket", "total", "value_sum", "below"]
    cells = (
        _inside(counted, located)
        .selectExpr(*kept, "value", "n", cell)
        .groupBy(*kept, "cell")
        .agg(F.expr("sum(n) as in_cell"), F.expr("min(value) as low"), F.expr("max(value) as high"))
    )
    before = "partition by name order by cell rows between unbounded preceding and 1 preceding"
    passed = cells.selectExpr("*", f"below + coalesce(sum(in_cell) over ({before}), 0) as passed")
    inside = passed.where("rank >= passed and rank < passed + in_cell")
    return inside.selectExpr(*[f"passed as {c}" if c == "below" else c for c in kept], "low", "high")


def _value_of(name: str) -> str:
    return f"max(case when name = '{name}' then value end)"


def interpolated(values: DataFrame, value: str, points: dict[str, float], places: int) -> DataFrame:
    """One row: a column per point, interpolated linearly between the two nearest ranks, and the mean."""
    ranks = {f"{name}_low": f"floor((total - 1) * {p}D)" for name, p in points.items()}
    ranks |= {f"{name}_high": f"ceil((total - 1) * {p}D)" for name, p in points.items()}
    columns = []
    for name, p in points.items():
        low, high, place = _value_of(f"{name}_low"), _value_of(f"{name}_high"), f"(max(total) - 1) * {p}D"
        exact = f"{low} + ({high} - {low}) * ({place} - floor({place}))"
        columns.append(F.expr(f"{rounded(exact, places)} as {name}"))
    columns.append(F.expr(f"{rounded('max(mean)', places)} as mean"))
    return order_statistics(values, value, ranks).agg(*columns)


def nearest_rank(values: DataFrame, value: str, points: dict[str, float], places: int) -> DataFrame:
    """One row with a column per point: the value at zero-based rank ``min(int(n * p / 100), n - 1)``."""
    ranks = {name: f"least(floor(total * {p}D / 100D), total - 1)" for name, p in points.items()}
    found = order_statistics(values, value, ranks)
    return found.agg(*[F.expr(f"{rounded(_value_of(name), places)} as {name}") for name in points])


def latency_percentiles(alerts: DataFrame) -> DataFrame:
    """Interpolated percentiles and mean of the alert latency, one row per metric."""
    row = interpolated(alerts, "detection_latency_ms", INTERPOLATED, 1)
    return row.unpivot([], row.columns, "metric", "latency_ms")


def approximate_percentiles(values: DataFrame, value: str, points: dict[str, float]) -> DataFrame:
    """Sketched percentiles: one pass, rank error of at most one in ten thousand."""
    return values.agg(*[F.percentile_approx(value, p, 10_000).alias(name) for name, p in points.items()])
