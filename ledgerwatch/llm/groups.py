"""Working through sorted rows group by group inside a task, and splitting large groups into pairs of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.skew import short


def group_starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Positions at which a new group of equal keys begins, in rows sorted by them."""
    changed = np.zeros(len(frame), bool)
    changed[:1] = True
    for key in keys:
        values = frame[key].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The batches of rows sorted by ``keys``, cut only between groups."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = int(group_starts(batch, keys)[-1])
        if held and any(batch[k].iloc[0] != held[-1][k].iloc[-1] for k in keys):
            yield pd.concat(held, ignore_index=True)
            held = []
        if last:
            yield pd.concat([*held, batch.iloc[:last]], ignore_index=True)
            held = []
        held.append(batch.iloc[last:])
    if held:
        yield pd.concat(held, ignore_index=True)


def block_pairs(rows: DataFrame, keys: list[str], node: str, block_rows: int, most: int = 10_000) -> DataFrame:
    """``rows`` dealt to pairs of blocks of their group and sorted.

    A group has a block for each ``block_rows`` rows. Each pair of blocks, also of a block with
    itself, meets in one place: ``low`` and ``high`` name the pair and ``block`` the row's own. So
    any two rows of a group meet exactly once, and no task ever holds more than two blocks of a
    group. Only groups of more than one block need their size: up to ``most`` of them are broadcast,
    more are joined by a shuffle.
    """
    large = rows.groupBy(*keys).agg(F.count("*").alias("group_rows")).where(f"group_rows > {block_rows}")
    dealt = (
        rows.join(short(large, most), keys, "left")
        .selectExpr("*", f"cast(ceil(coalesce(group_rows, 1) / {block_rows}) as int) as blocks")
        .selectExpr("*", f"cast(pmod(xxhash64({node}), blocks) as int) as block")
        .selectExpr("*", "explode(sequence(0, blocks - 1)) as other")
        .selectExpr("*", "least(block, other) as low", "greatest(block, other) as high")
        .drop("group_rows", "blocks", "other")
    )
    place = [*keys, "low", "high"]
    return dealt.repartition(*place).sortWithinPartitions(*place, "block", node)


def first_of_links(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions the first one that the links ``a - b`` reach."""
    first = np.arange(n)
    while True:
        low = np.minimum(first[a], first[b])
        before = first.copy()
        np.minimum.at(first, a, low)
        np.minimum.at(first, b, low)
        np.minimum.at(first, before, first)
        first = first[first]
        if (first == before).all():
            return first
