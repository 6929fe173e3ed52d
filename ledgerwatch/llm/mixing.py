"""Mixing sources to target weights over a tree of budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved, unused, word_count
from ledgerwatch.operators.skew import short

LEVELS = ("domain", "lang", "source")
NONE = "(none)"

#: A hash bucket of a leaf is to hold about this many documents.
BUCKET_DOCS = 1024
BROADCAST_LEAVES = 10_000


def source_domain(source: str = "source") -> str:
    """The domain of a source: numbered sources in groups of five, anything else by itself; of a null one ``NONE``."""
    number = f"try_cast(regexp_extract({source}, '^src([0-9]{{1,9}})$', 1) as int)"
    return f"coalesce(concat('domain', cast({number} div 5 as string)), {source}, '{NONE}')"


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> str:
    """SQL for the weight of a value at a level: as given, or one."""
    cases = "".join(f" when '{v}' then {w}" for v, w in weights.get(level, {}).items())
    return f"cast(case {level}{cases} else 1 end as decimal(18,0))" if cases else "cast(1 as decimal(18,0))"


def leaf_budgets(
    leaves: DataFrame,
    weights: dict[str, dict[str, int]],
    max_epochs: int,
    budget: int | None = None,
    levels: tuple[str, ...] = LEVELS,
) -> DataFrame:
    """Add ``target`` to ``leaves(*levels, n_docs, tokens)``: the tokens to take from each leaf.

    ``budget`` is the number of tokens to take, by default as many as there are. A node's capacity
    is ``max_epochs`` times the tokens below it. From the root down, children share their parent's
    budget by weight; a child that cannot use its share is given its capacity, and what is left over
    goes to its siblings by weight. Only what a whole family cannot use was left to the families
    beside it, as the family's capacity already limited its own share. All numbers are integers; a
    share is rounded down, so less than one token per child stays unspent.
    """
    nodes = leaves.selectExpr("*", f"cast(tokens as decimal(20,0)) * {max_epochs} as capacity")
    if budget is None:
        budget = leaves.agg(F.sum("tokens")).first()[0] or 0
    shares: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[: depth - 1]
        children = nodes.groupBy(*path).agg(F.expr("cast(sum(capacity) as decimal(38,0)) as capacity"))
        children = children.selectExpr("*", f"{weight_of(path[-1], weights)} as weight")
        children = (
            children.selectExpr("*", f"cast({budget} as decimal(38,0)) as granted")
            if shares is None
            else children.join(shares, list(parent))
        )
        family = f"partition by {', '.join(parent) or '1'}"
        order = f"{family} order by cast(capacity as double) / cast(weight as double), {path[-1]}"
        before = "rows between unbounded preceding and 1 preceding"
        after = "rows between current row and unbounded following"
        tested = children.where("weight > 0").selectExpr(
            "*",
            f"granted - coalesce(cast(sum(capacity) over ({order} {before}) as decimal(38,0)), 0) as left_over",
            f"cast(sum(weight) over ({order} {after}) as decimal(18,0)) as competing",
        )
        # Children in order of capacity per weight: the first ones cannot use their share.
        full = tested.selectExpr("*", "capacity * competing <= left_over * weight as full")
        shares = full.selectExpr(
            *path,
            f"""cast(if(full, capacity, greatest(0,
                max(if(full, null, left_over)) over ({family}) * weight
                div max(if(full, null, competing)) over ({family}))) as decimal(38,0)) as granted""",
        )
    return leaves.join(shares, list(levels), "left").selectExpr(
        *leaves.columns, "cast(coalesce(granted, 0) as bigint) as target"
    )


def epoch_order(doc_id: str, epoch: str, seed: int) -> str:
    """The place of a document in an epoch: an md5 text, which every engine sorts alike."""
    return f"md5(cast(concat({seed}, ':', {epoch}, ':', coalesce(cast({doc_id} as string), '')) as binary))"


def leaf_cutoffs(docs: DataFrame, budgets: DataFrame, seed: int, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Per leaf: ``whole`` epochs, and the last place taken in the next one (``last_place``; null:
    none).

    ``docs`` has ``(*levels, doc_id, n_tokens)``. A leaf's order is split into buckets by the
    leading digits of the place, as many as the leaf needs; only the bucket in which the budget ends
    is looked at row by row.
    """
    leaf = list(levels)
    plan = budgets.where("target > 0 and tokens > 0").selectExpr(
        *leaf,
        "target div tokens as whole",
        "target % tokens as rest",
        f"cast(greatest(0, ceil(log(16, n_docs / {BUCKET_DOCS}D))) as int) as digits",
    )
    # Lists of leaves are broadcast while they are short, so that a leaf with very many documents is not dealt by its key.
    placed = (
        docs.join(short(plan.where("rest > 0"), BROADCAST_LEAVES), leaf)
        .selectExpr(*leaf, "rest", "digits", "n_tokens", f"{epoch_order('doc_id', 'whole', seed)} as place")
        .selectExpr("*", "substring(place, 1, digits) as bucket")
    )
    by_leaf = f"partition by {', '.join(leaf)}"
    before = "rows between unbounded preceding and 1 preceding"
    # The last bucket that begins before the budget is spent.
    ends = (
        placed.groupBy(*leaf, "rest", "bucket")
        .agg(F.sum("n_tokens").alias("n"))
        .selectExpr(*leaf, "rest", "bucket", f"coalesce(sum(n) over ({by_leaf} order by bucket {before}), 0) as spent")
        .where("spent < rest")
        .groupBy(*leaf)
        .agg(F.expr("max(struct(bucket, spent)) as last"))
        .selectExpr(*leaf, "last.bucket", "last.spent")
    )
    rows = placed.join(short(ends, BROADCAST_LEAVES), [*leaf, "bucket"]).groupBy(*leaf, "rest", "spent", "place").agg(F.sum("n_tokens").alias("n"))
    last = (
        rows.selectExpr(*leaf, "place", f"spent + coalesce(sum(n) over ({by_leaf} order by place {before}), 0) < rest as taken")
        .where("taken")
        .groupBy(*leaf)
        .agg(F.max("place").alias("last_place"))
    )
    return plan.join(last, leaf, "left").select(*leaf, "whole", "last_place")


def mix(
    docs: DataFrame,
    weights: dict[str, dict[str, int]],
    max_epochs: int = 2,
    budget: int | None = None,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    levels: dict[str, str] | None = None,
) -> DataFrame:
    """The rows of ``docs`` that fill the budget, one row per epoch in which a document is read.

    ``levels`` names the levels of the tree, root first, with an SQL expression over ``docs`` for
    each; null values are a value of their own. Each epoch of a leaf has its own seeded order. A
    leaf reads whole epochs and then the shortest prefix of documents of the next one that reaches
    its target (so it may exceed it by part of one document). Rows of a leaf with equal ids are read
    together. Documents without words cost nothing and come along where their place falls. Adds
    ``domain``, ``lang``, ``source`` or whatever the levels are called, ``n_tokens`` (words) and
    ``epoch`` (from 0) in the struct column ``mixed``; columns of ``docs`` stay. An empty table gives no rows.
    """
    levels = levels or {"domain": source_domain(), "lang": "lang", "source": "source"}
    names = tuple(levels)
    mixed = unused(docs, "mixed")
    path = [f"coalesce(cast({sql} as string), '{NONE}') as {name}" for name, sql in levels.items()]
    tokens = unused(docs, "n_tokens_")
    counted = docs.withColumn(tokens, word_count(text))
    narrow = saved(counted.selectExpr(f"`{doc_id}` as doc_id", f"{tokens} as n_tokens", *path))
    leaves = narrow.groupBy(*names).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    budgets = saved(leaf_budgets(saved(leaves), weights, max_epochs, budget, names))
    cutoffs = saved(leaf_cutoffs(narrow, budgets, seed, names)).selectExpr(
        f"struct({', '.join(names)}) as leaf", "whole", "last_place"
    )
    keep = unused(docs, "leaf_")
    rows = counted.withColumn(keep, F.expr(f"struct({', '.join(path)})"))
    cut = unused(rows, "cut_")
    # Up to this many leaves are broadcast, so that no text is shuffled; more are joined by a shuffle.
    cutoffs = short(cutoffs.select(F.struct("leaf", "whole", "last_place").alias(cut)), BROADCAST_LEAVES)
    joined = rows.join(cutoffs, F.col(keep) == F.col(f"{cut}.leaf"))
    place = epoch_order(f"`{doc_id}`", f"{cut}.whole", seed)
    epochs = f"cast({cut}.whole as int) + if(coalesce({place} <= {cut}.last_place, false), 1, 0)"
    fields = ", ".join(f"{keep}.{name} as {name}" for name in names)
    epoch = unused(joined, "epoch_")
    read = joined.selectExpr("*", f"posexplode(array_repeat(0, {epochs})) as ({epoch}, {epoch}0)")
    added = f"struct({fields}, {tokens} as n_tokens, {epoch} as epoch) as {mixed}"
    return read.selectExpr(*[f"`{c}`" for c in docs.columns], added)
