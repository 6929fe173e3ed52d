"""Summaries that are merged, and selection in crowded buckets, against exact answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import percentiles as pc
from ledgerwatch.operators import sketches as sk
from ledgerwatch.operators.windows import window_activity, window_activity_approx


@pytest.mark.parametrize("share", [0.3, 0.02, 0.001])
def test_every_heavy_group_is_found(spark, share):
    """A skewed table with very many small groups; the counts are exact."""
    rows = spark.range(200_000).selectExpr(
        "id % 64 as batch", "if(id % 3 = 0, 'hot', concat('g', cast(floor(pow(pmod(hash(id), 100000) / 100000D, 4) * 50000) as string))) as name"
    )
    counts = {r.name: r["count"] for r in rows.groupBy("name").count().collect()}
    heavy = {name: n for name, n in counts.items() if n >= share * 200_000}
    found = sk.heavy_groups(rows, "name", share)
    assert {r.name: r.n for r in found.collect()} == heavy and "hot" in heavy
    parts = rows.groupBy("batch").agg(F.expr(f"{sk.group_summary('name', share)} as summary"))
    merged = {r.item: r.estimate for r in sk.heavy_candidates(parts, "summary", share).collect()}
    assert set(heavy) <= set(merged)
    assert all(abs(merged[name] - n) <= share / 16 * 200_000 for name, n in heavy.items())


def test_heavy_groups_of_nothing(spark):
    none = spark.createDataFrame([(None,), (None,)], "name string")
    assert sk.heavy_groups(none, "name", 0.1).count() == 0
    assert sk.heavy_groups(none.limit(0), "name", 0.1).count() == 0


def test_merged_quantiles_keep_their_rank_error(spark):
    draw = np.random.default_rng(5)
    values = np.concatenate([draw.lognormal(3, 2, 60_000), np.full(20_000, 7.25)])
    rows = spark.createDataFrame([(int(k) % 500, float(v)) for k, v in enumerate(values)], "minute int, value double")
    minutes = rows.groupBy("minute").agg(F.expr(f"{sk.quantile_summary('value')} as summary"))
    points = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p999": 0.999}
    found = sk.quantiles(minutes, "summary", points).first()
    assert found.n == len(values)
    for name, p in points.items():
        assert (values < found[name]).mean() <= p + sk.RANK_ERROR and (values <= found[name]).mean() >= p - sk.RANK_ERROR
    empty = sk.quantiles(minutes.limit(0), "summary", points).first()
    assert empty.n == 0 and empty.p50 is None


def test_sketched_distinct_numbers(spark):
    """Ten thousand merchants in a window: the estimate is near, and the same however the rows are split."""
    rows = spark.range(60_000).selectExpr(
        "concat('A', id % 3) as account_id", "concat('M', pmod(hash(id), 10000)) as merchant_id", "concat('C', id % 7) as country",
        "1.5D as amount", "timestamp_micros(1704067200000000 + (id % 600) * 1000000) as event_time",
    )
    keys = ["window_start", "account_id"]
    exact = window_activity(rows).toPandas().set_index(keys).sort_index()
    near = window_activity_approx(rows).toPandas().set_index(keys).sort_index()
    assert (exact.index == near.index).all() and (exact.window_txn_count == near.window_txn_count).all()
    assert (exact.window_distinct_countries == near.window_distinct_countries).all()
    error = (near.window_distinct_merchants / exact.window_distinct_merchants - 1).abs()
    assert exact.window_distinct_merchants.max() > 5_000 and error.max() < 0.06 and error.mean() < 0.02


def test_crowded_bucket_is_narrowed(spark):
    """A million distinct values in one bucket: what is left to sort is a handful."""
    n = 1_000_000
    values = spark.range(n).selectExpr("1000 + id * 1e-7 as value")
    exact = pc.interpolated(values, "value", pc.INTERPOLATED, 6).first()
    for name, p in pc.INTERPOLATED.items():
        assert exact[name] == pytest.approx(1000 + (n - 1) * p * 1e-7, abs=1e-6)
    counted = values.selectExpr("value", "1L as n", f"{pc.BUCKET} as bucket").cache()
    assert counted.select("bucket").distinct().count() == 1
    located = counted.groupBy("bucket").agg(F.expr("min(value) as low"), F.expr("max(value) as high")).selectExpr(
        "bucket", "low", "high", "0L as below", f"{n}L as total", "0D as value_sum", "'x' as name", f"{n // 3}L as rank"
    )
    for most in (n // pc.CELLS + 2, 3):
        located = pc.narrowed(counted, located).cache()
        at = located.first()
        inside = counted.where(f"value >= {at.low!r}D and value <= {at.high!r}D").count()
        assert inside <= most and at.below <= n // 3 < at.below + inside


def test_odd_values_are_narrowed(spark):
    values = [float("nan"), float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, 1.7000000001e308, 1.0, 1.0]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "value double")
    ordered = sorted(values, key=lambda v: (v != v, v if v == v else 0.0))
    for k in range(len(values)):
        found = pc.order_statistics(frame, "value", {"at": f"{k}"}).first().value
        assert found == ordered[k] or found != found and ordered[k] != ordered[k]
