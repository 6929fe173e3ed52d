"""Accounts with a large share of the rows are cut into slices; results must not change."""

import pytest

from ledgerwatch.config import SkewConfig
from ledgerwatch.operators import detectors, velocity
from ledgerwatch.operators import skew as cutting
from ledgerwatch.operators.skew import find_slices
from ledgerwatch.sources import events
from tests.compare import assert_same

WHOLE = SkewConfig(slice_rows=10**9)
CUT = SkewConfig(slice_rows=15)


@pytest.fixture(scope="module")
def skewed(spark, medium):
    """A third of all rows belong to one account."""
    rows = events.transactions(spark, medium)
    account = "if(pmod(hash(transaction_id), 3) = 0, 'ACC000000', account_id) as account_id"
    return rows.selectExpr(*[account if c == "account_id" else c for c in rows.columns])


@pytest.fixture(scope="module")
def tied(skewed):
    """Half of the busy account's rows carry the same microsecond, and two more blocks lie a gap apart."""
    number = "cast(substring(transaction_id, 4) as bigint)"
    moved = f"""case when account_id <> 'ACC000000' or {number} % 2 = 0 then event_time
        else cast(timestamp_micros(1704070800000000 + ({number} % 14 div 6) * 300000000) as timestamp_ntz) end as event_time"""
    return skewed.selectExpr(*[moved if c == "event_time" else c for c in skewed.columns])


def timed(rows):
    return rows.selectExpr("account_id", "transaction_id", "unix_micros(cast(event_time as timestamp)) as us")


def slice_sizes(slices, rows):
    sizes = slices.cut(rows).where("account_id = 'ACC000000'").groupBy("slice").count()
    return sizes.count(), sizes.agg({"count": "max"}).first()[0]


def test_busy_account_is_spread_over_even_slices(spark, skewed):
    slices = find_slices(timed(skewed), SkewConfig(slice_rows=100))
    assert [r.account_id for r in slices.accounts.collect()] == ["ACC000000"]
    number, largest = slice_sizes(slices, timed(skewed))
    assert 25 < number < 45 and largest < 200


@pytest.mark.parametrize("us", ["1000000L", "us - pmod(us, 8640000000) + pmod(us, 2000000)"])
def test_rows_of_one_time_are_spread_too(spark, skewed, us):
    """All rows of the account fall into one microsecond, or into two seconds of a long time line."""
    burst = timed(skewed).selectExpr("account_id", "transaction_id", f"if(account_id = 'ACC000000', {us}, us) as us")
    number, largest = slice_sizes(find_slices(burst, SkewConfig(slice_rows=100)), burst)
    assert 25 < number < 45 and largest < 200


def test_twenty_thousand_rows_of_one_microsecond(spark):
    rows = spark.range(20_000).selectExpr(
        "concat('T', lpad(id, 6, '0')) as transaction_id", "'A' as account_id", "1.5D as amount", "id % 1000 as n",
        "timestamp'2024-01-01 00:00:00' as event_time",
    )
    skew = SkewConfig(slice_rows=1000)
    number, largest = find_slices(timed(rows), skew).cut(timed(rows)).groupBy("slice").count().selectExpr("count(*)", "max(count)").first()
    assert 12 < number < 25 and largest < 2000
    counted = velocity.session_velocity(rows, skew)
    assert counted.where("window_count <> cast(substring(transaction_id, 2) as bigint) + 1").isEmpty()
    trailing = velocity.trailing_velocity(rows, skew)
    assert {tuple(r) for r in trailing.select("window_count", "window_spend").distinct().collect()} == {(20_000, 30_000.0)}


def test_any_number_of_accounts_is_cut(spark):
    """Far more accounts than a broadcast list may have: all are cut."""
    rows = spark.range(300_000).selectExpr("concat('A', id % 1000) as account_id", "id as transaction_id", "id as us")
    slices = find_slices(rows, SkewConfig(slice_rows=20, max_keys=100))
    assert slices.accounts.count() == 1_000
    sizes = slices.cut(rows).groupBy("account_id", "slice").count()
    assert sizes.agg({"count": "max"}).first()[0] < 100 and sizes.count() == 10_000


def test_a_row_meets_short_lists_only(spark):
    """Thousands of slices of one account: what a row is joined with to find its slice stays as short."""
    rows = spark.range(200_000).selectExpr("'A' as account_id", "id as transaction_id", "id div 30000 as us")
    slices = find_slices(rows, SkewConfig(slice_rows=40))
    assert [stride for stride, _ in slices.levels] == [4096, 64, 1]
    assert all(lists.selectExpr("max(size(starts))").first()[0] < 64 for _, lists in slices.levels)
    cut = slices.cut(rows).cache()
    sizes = cut.groupBy("slice").count().selectExpr("count(*)", "max(slice)", "max(count)").first()
    assert 4_500 < sizes[0] == sizes[1] + 1 and sizes[2] < 120
    # The order of the rows, which compares the ids as text, is that of the slices.
    back = "lag(slice) over (order by us, cast(transaction_id as string)) > slice as back"
    assert cut.selectExpr(back).where("back").isEmpty()
    cut.unpersist()


@pytest.mark.parametrize("max_keys", [1, 1_024])
def test_levels_of_any_width_give_the_same(tied, monkeypatch, max_keys):
    monkeypatch.setattr(cutting, "FAN_OUT", 2)
    monkeypatch.setattr(cutting, "PER_SLICE", 2)
    skew = SkewConfig(slice_rows=15, max_keys=max_keys)
    assert len(find_slices(timed(tied), skew).levels) > 5
    for operator in (velocity.session_velocity, velocity.trailing_velocity):
        assert_same(operator(tied, skew).toPandas(), operator(tied, WHOLE).toPandas())


def test_few_rows_are_not_cut(spark, skewed):
    assert find_slices(timed(skewed), SkewConfig()).accounts is None
    assert find_slices(timed(skewed).limit(0), CUT).accounts is None


def test_long_and_short_lists_give_the_same(skewed):
    long = SkewConfig(slice_rows=15, max_keys=1)
    assert_same(velocity.session_velocity(skewed, long).toPandas(), velocity.session_velocity(skewed, WHOLE).toPandas())


def test_a_busy_account_with_many_merchants_is_spread(spark):
    """All rows on one account in one window, each with its own merchant: no task holds more than its share."""
    from ledgerwatch.operators import windows

    rows = spark.range(20_000).selectExpr(
        "'A' as account_id", "concat('M', id) as merchant_id", "'US' as country", "1.5D as amount",
        "cast(timestamp_micros(1704067200000000 + id) as timestamp_ntz) as event_time",
    )
    found = windows.window_activity(rows)
    assert {(r.window_distinct_merchants, r.window_total_spend) for r in found.collect()} == {(20_000, 30_000.0)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "name" in plan


@pytest.mark.parametrize("table", ["skewed", "tied"])
@pytest.mark.parametrize(
    "operator",
    [
        lambda rows, skew: velocity.session_velocity(rows, skew).select("transaction_id", "window_count", "window_spend"),
        lambda rows, skew: velocity.trailing_velocity(rows, skew),
        lambda rows, skew: detectors.geo_impossible(rows, skew=skew),
        lambda rows, skew: detectors.card_testing(rows, skew=skew),
        lambda rows, skew: detectors.spend_anomaly(rows, skew=skew),
    ],
    ids=["session", "trailing", "geo", "card", "spend"],
)
def test_cut_and_whole_accounts_agree(request, table, operator):
    rows = request.getfixturevalue(table)
    assert_same(operator(rows, CUT).toPandas(), operator(rows, WHOLE).toPandas())


def test_pauses_anywhere(spark, monkeypatch):
    """Sessions that end inside a slice, at its end, in a slice of ties, and none at all."""
    import random

    monkeypatch.setattr(cutting, "PER_SLICE", 2)
    draw = random.Random(2)
    for _ in range(4):
        at, rows = 0, []
        for k in range(400):
            at += draw.choice([0, 0, 0, 1, 100, 299, 300, 301, 5000])
            rows.append((f"T{k:04d}", draw.choice("AAAB"), float(k), 1_704_067_200 + at))
        frame = spark.createDataFrame(rows, "transaction_id string, account_id string, amount double, at long")
        frame = frame.selectExpr("transaction_id", "account_id", "amount", "timestamp_seconds(at) as event_time")
        for skew in (SkewConfig(slice_rows=3), SkewConfig(slice_rows=40)):
            assert_same(velocity.session_velocity(frame, skew).toPandas(), velocity.session_velocity(frame, None).toPandas())


def test_open_sessions_of_a_table(spark, skewed):
    from ledgerwatch.functions.scores import score_transactions

    scored = score_transactions(velocity.session_velocity(skewed)).cache()
    newest = {}
    for r in scored.select("account_id", "event_time", "transaction_id", "window_count", "window_spend").collect():
        newest[r.account_id] = max(newest.get(r.account_id, (r.event_time, "")), (r.event_time, r.transaction_id, r.window_count, r.window_spend))
    found = velocity.open_sessions(scored).selectExpr("account_id", "n", "cast(units as double) / 10000 as spend").collect()
    assert {r.account_id: (r.n, r.spend) for r in found} == {a: v[2:] for a, v in newest.items()}


def test_reduce_tasks_are_balanced(spark, skewed):
    """No task of the windows holds much more than its share, though one account has a third."""
    skew = SkewConfig(slice_rows=50)
    counted = velocity.session_velocity(skewed, skew=skew).selectExpr("spark_partition_id() as task", "window_spend")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in counted.where("window_spend > -1").groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8
    assert max(sizes) < 1.5 * sum(sizes) / len(sizes)
