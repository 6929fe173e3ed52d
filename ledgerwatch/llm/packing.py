"""Packing documents into training sequences of several permitted lengths."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved, word_count

SIZES = (512, 1024, 2048, 4096, 8192)

#: Pieces of one length are numbered in parts of about this many.
PART_ROWS = 50_000


@dataclass(frozen=True)
class Cost:
    """What a sequence of ``size`` tokens costs: a fixed part, one per token, and attention, which is
    quadratic.
    """

    fixed: float = 64.0
    quadratic: float = 2.0**-16

    def __call__(self, size: int) -> float:
        return self.fixed + size + self.quadratic * size * size


@dataclass
class Bins:
    """``n`` bins from ``first`` on that are filled alike."""

    first: int
    n: int
    size: int
    content: int = 0


@dataclass
class Plan:
    """How many pieces of which length go where.

    A slot row tells that the pieces of ``length`` numbered from ``start`` on go, ``each``
    to a bin, into the bins from ``first`` on, behind ``content`` tokens.
    """

    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    bins: list[Bins] = field(default_factory=list)
    cost: float = 0.0


def best_fit(histogram: dict[int, int], opened: tuple[int, ...], permitted: tuple[int, ...], cost: Cost) -> Plan:
    """Best-fit decreasing over numbers of pieces per length.

    A piece goes into the open bin with the least room that holds it (of equal ones the first). If
    there is none, the size of ``opened`` with the least cost per token that can still fill
    it is opened. In the end each bin gets the smallest permitted size that holds its contents. Pieces of
    one length are handled together: they fill the tightest bins one after the other, as
    many as fit into each, so the work depends on the number of lengths and not of pieces.
    """
    plan = Plan()
    rooms: list[tuple[int, int, int]] = []  # (room, first bin, position in plan.bins), in order
    smaller = sum(length * n for length, n in histogram.items())
    next_bin = 0
    for length in sorted(histogram, reverse=True):
        count, start = histogram[length], 0
        fits = [s for s in opened if s >= length]
        size = min(fits, key=lambda s: (cost(s) / min(s, smaller), s))
        smaller -= length * count
        while start < count:
            at = bisect.bisect_left(rooms, (length, -1, -1))
            if at < len(rooms):
                room, first, k = rooms.pop(at)
                bins = plan.bins[k]
            else:
                room, first = size, next_bin
                bins = Bins(first, -(-(count - start) // (size // length)), size)
                next_bin += bins.n
                k = len(plan.bins)
                plan.bins.append(bins)
            each, left = room // length, count - start
            whole = min(bins.n, left // each)
            parts = [(whole, each)] if whole else []
            if whole < bins.n and left - whole * each:
                parts.append((1, left - whole * each))
            rest = bins.n - sum(n for n, _ in parts)
            if rest:
                parts.append((rest, 0))
            content = bins.content
            for i, (n, pieces) in enumerate(parts):
                if i:
                    k = len(plan.bins)
                    plan.bins.append(Bins(first, n, bins.size, content))
                plan.bins[k].n = n
                plan.bins[k].content = content + pieces * length
                if pieces:
                    plan.slots.append((length, start, first, pieces, content))
                    start += n * pieces
                room = plan.bins[k].size - plan.bins[k].content
                if room:
                    bisect.insort(rooms, (room, first, k))
                first += n
    for bins in plan.bins:
        bins.size = min(s for s in permitted if s >= bins.content)
        plan.cost += bins.n * cost(bins.size)
    return plan


def cheapest_plan(histogram: dict[int, int], sizes: tuple[int, ...], cost: Cost) -> Plan:
    """The cheapest plan, after downsizing, of those that open all sizes, all but the smallest, and so on."""
    sizes = tuple(sorted(sizes))
    plans = [best_fit(histogram, sizes[k:], sizes, cost) for k in range(len(sizes))]
    return min(plans, key=lambda plan: plan.cost)


def pack(
    docs: DataFrame,
    sizes: tuple[int, ...] = SIZES,
    cost: Cost | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    n_tokens: str | None = None,
) -> DataFrame:
    """``doc_id, piece, start_token, n_tokens, bin_id, bin_offset, bin_size`` for every piece of every row.

    Tokens are words unless a column ``n_tokens`` counts them. A document longer than the
    largest size is cut into pieces of that size and a rest. A document without tokens (null,
    empty or blank text) is one piece of none and has no bin (nulls). Rows without id
    and repeated rows are packed like any others, each by itself; other columns are ignored. An empty table gives no rows.

    The driver sees one number per length, at most the largest size of them, and lays out the bins;
    pieces are numbered within their length and look up their bin by length and number. A common
    length is numbered in many parts.
    """
    cost = cost or Cost()
    largest = max(sizes)
    tokens = word_count(text) if n_tokens is None else F.coalesce(F.col(n_tokens).cast("long"), F.lit(0).cast("long"))
    lengths = saved(
        docs.select(
            F.col(doc_id).alias("doc_id"), tokens.alias("total"), F.xxhash64(F.col(doc_id), F.col(text)).alias("mark")
        )
    )
    pieces = lengths.selectExpr(
        "doc_id", "mark", "total", f"explode(sequence(0, greatest(total - 1, 0) div {largest})) as piece"
    ).selectExpr(
        "doc_id", "mark", f"cast(piece as long) as piece", f"least({largest}, total - piece * {largest}) as n_tokens"
    )
    spark = docs.sparkSession
    histogram = {r[0]: r[1] for r in pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()}
    plan = cheapest_plan(histogram, sizes, cost)

    part = f"pmod(xxhash64(mark, piece), 1 + n_pieces div {PART_ROWS})"
    counts = spark.createDataFrame(list(histogram.items()), "n_tokens long, n_pieces long")
    parted = pieces.join(F.broadcast(counts), "n_tokens").selectExpr(
        "doc_id", "mark", "piece", "n_tokens", f"{part} as part"
    )
    before = "partition by n_tokens order by part rows between unbounded preceding and 1 preceding"
    offsets = (
        parted.groupBy("n_tokens", "part")
        .agg(F.count("*").alias("n"))
        .selectExpr("n_tokens", "part", f"coalesce(sum(n) over ({before}), 0) as numbered")
    )
    number = "row_number() over (partition by n_tokens, part order by mark, doc_id, piece)"
    numbered = (
        parted.selectExpr("*", f"{number} - 1 as place")
        .join(offsets, ["n_tokens", "part"])
        .selectExpr("doc_id", "piece", "n_tokens", "place + numbered as number")
    )
    placed = numbered.select("doc_id", "piece", "n_tokens", _slot(spark, plan)("n_tokens", "number").alias("slot"))
    packed = placed.selectExpr(
        "doc_id",
        "piece",
        f"piece * {largest} as start_token",
        "n_tokens",
        "slot.bin_id as bin_id",
        "slot.bin_offset as bin_offset",
        "slot.bin_size as bin_size",
    )
    nothing = pieces.where("n_tokens = 0").selectExpr(
        "doc_id",
        "piece",
        "0L as start_token",
        "n_tokens",
        "cast(null as long) as bin_id",
        "cast(null as long) as bin_offset",
        "cast(null as long) as bin_size",
    )
    return packed.unionByName(nothing)


def _slot(spark, plan: Plan):
    """A function from length and number of a piece to its bin, place in the bin and the bin's size."""
    slots = np.array(sorted(plan.slots), np.int64).reshape(-1, 5)
    bins = np.array(sorted((b.first, b.size) for b in plan.bins), np.int64).reshape(-1, 2)
    shared = spark.sparkContext.broadcast((slots, bins))

    @F.pandas_udf("bin_id long, bin_offset long, bin_size long")
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        slots, bins = shared.value
        keys = slots[:, 0] * 2**40 + slots[:, 1]
        for lengths, numbers in batches:
            length, number = lengths.to_numpy(), numbers.to_numpy()
            _, start, first, each, content = slots[np.searchsorted(keys, length * 2**40 + number, "right") - 1].T
            bin_id = first + (number - start) // each
            size = bins[np.searchsorted(bins[:, 0], bin_id, "right") - 1, 1]
            offset = content + (number - start) % each * length
            yield pd.DataFrame({"bin_id": bin_id, "bin_offset": offset, "bin_size": size})

    return find
