"""Cutting the time line of busy accounts into slices.

Work along the time line of one account (running sums, previous row) would put all rows of that account
into one task. The rows of a table are therefore seen in order of account, time and id, and boundaries are
taken from a sample of them, so that about equally many rows lie between two of them. An account that holds
several boundaries is cut there; what a slice must know about the earlier ones is one row that is carried
on from slice to slice.

A row finds its slice from level to level: the boundaries are kept in short lists, and which list of a level a row
meets is told by the level above. So what a row is joined with does not grow with the number of slices.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.config import SkewConfig

#: Rows of the sample between two boundaries: slices differ by about a sixth.
PER_SLICE = 32

#: Every level of the lists of boundaries divides the one above by this: a list has at most one less.
FAN_OUT = 64


def _position(key: str) -> str:
    """How many of the sorted ``starts`` are not above ``key``, by halving."""
    middle = "cast((at.low + at.high) div 2 as int)"
    return f"""aggregate(sequence(1, length(bin(size(starts)))), named_struct('low', 0, 'high', size(starts)),
        (at, i) -> case when at.low >= at.high then at
            when get(starts, {middle}) <= {key} then named_struct('low', {middle} + 1, 'high', at.high)
            else named_struct('low', at.low, 'high', {middle}) end).low"""


@dataclass(frozen=True)
class Slices:
    """The accounts that are cut (``account_id``), none if there is no such account, and the starts (time and id) of all
    slices but the first. ``tie`` is the expression that orders rows of equal time.

    The starts are numbered from 1 in their account. ``levels`` has, from the widest stride to 1, sorted lists ``starts`` of
    those whose number is divisible by the stride and not by the next one, by ``account_id`` and the last number before
    them (``slice``) that is.
    """

    accounts: DataFrame | None
    tie: str
    levels: tuple[tuple[int, DataFrame], ...] = ()

    def cut(self, rows: DataFrame) -> DataFrame:
        """Add ``slice``, the number of the row's slice in its account; 0 in accounts that are not cut."""
        key = f"named_struct('us', us, 'id', cast({self.tie} as string))"
        sliced = rows.selectExpr("*", "0 as slice")
        for stride, lists in self.levels:
            found = f"cast(slice + {stride} * coalesce({_position(key)}, 0) as int) as slice"
            sliced = sliced.join(lists, ["account_id", "slice"], "left").selectExpr(*rows.columns, found)
        return sliced

    def cut_rows(self, rows: DataFrame) -> DataFrame:
        """The rows of accounts that are cut, with ``slice``."""
        return self.cut(rows.join(self.accounts, "account_id", "left_semi").select(*rows.columns))


def short(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` as a list to broadcast if there are at most ``most``, else as they are.

    The list is computed here, once for all its uses.
    """
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        return rows
    return F.broadcast(rows.sparkSession.createDataFrame(found, rows.schema))


def find_slices(rows: DataFrame, skew: SkewConfig | None, tie: str = "transaction_id") -> Slices:
    """The slices for ``rows`` (``account_id``, ``us`` and what ``tie`` needs).

    Accounts with more rows than about two slices should have are cut, however many there are; there are
    at most half as many as slices. The sample only decides where: any sample gives the same results.
    Rows that are equal in account, time and ``tie`` stay together.
    """
    if skew is None:
        return Slices(None, tie)
    n = rows.count()
    parts = min(skew.max_slices, n // skew.slice_rows)
    if parts < 2:
        return Slices(None, tie)
    place = f"named_struct('us', us, 'id', cast({tie} as string))"
    sample = rows.sample(fraction=min(1.0, PER_SLICE * parts / n), seed=1).selectExpr("account_id", f"{place} as place")
    in_order = "partition by account_id order by place"
    ranked = sample.where("account_id is not null").selectExpr(
        "*", f"row_number() over ({in_order}) - 1 as k", "count(*) over (partition by account_id) as places"
    )
    chosen = ranked.where(f"places >= {2 * PER_SLICE} and k > 0 and k % {PER_SLICE} = 0")
    starts = chosen.select("account_id", "place").distinct().selectExpr("*", f"row_number() over ({in_order}) as number")
    strides = [1]
    while strides[0] * FAN_OUT <= 2 * parts:
        strides.insert(0, strides[0] * FAN_OUT)
    stride = f"array_max(array({', '.join(f'if(number % {s} = 0, {s}, 1)' for s in strides)}))"
    before = f"cast(if(stride = {strides[0]}, 0, number - number % (stride * {FAN_OUT})) as int) as slice"
    lists = (
        starts.selectExpr("*", f"{stride} as stride")
        .groupBy("account_id", "stride", F.expr(before))
        .agg(F.expr("array_sort(collect_list(place)) as starts"))
    )
    # About as many boundaries as slices at most; collected, so that all uses cut at the same ones.
    found = lists.collect()
    if not found:
        return Slices(None, tie)
    index = rows.sparkSession.createDataFrame(found, lists.schema)
    # The names are broadcast (a shuffle would bring a busy account's rows together), at most half as many as slices; so
    # are the lists above the last level, a 64th of all. Those of the last level are if they belong to a few accounts, or
    # else are joined by a shuffle, in which an account is spread over its lists.
    accounts = F.broadcast(index.select("account_id").distinct())
    few = len({r.account_id for r in found}) <= skew.max_keys
    levels = []
    for s in sorted({r.stride for r in found}, reverse=True):
        level = index.where(f"stride = {s}").drop("stride")
        levels.append((s, F.broadcast(level) if few or s > 1 else level))
    return Slices(accounts, tie, tuple(levels))
