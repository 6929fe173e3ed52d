"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node that can be reached.

    Alternates the two star operations of Kiveris et al. (2014): first all larger neighbours of
    a node are linked to its smallest neighbour, then the smaller ones. The graph ends as one
    star per component after a logarithmic number of rounds. Minima are aggregated before
    they are shuffled, the joins are ordinary ones that adaptive execution can split, and each
    round is written to the checkpoint folder. Edges from a node to itself keep the node.
    """
    edges = saved(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct())
    known = _fingerprint(edges)
    while True:
        edges = saved(_small_star(_large_star(edges)))
        now = _fingerprint(edges)
        if now == known:
            break
        known = now
    stars = edges.selectExpr("a as node", "b as component")
    return stars.unionByName(edges.selectExpr("b as node", "b as component")).groupBy("node").agg(
        F.min("component").alias("component")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
    least = both.groupBy("a").agg(F.expr("least(a, min(b)) as least"))
    linked = both.where("b > a").join(least, "a").selectExpr("b as a", "least as b")
    loops = edges.where("a = b")
    return linked.unionByName(loops).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.expr("min(b) as least"))
    moved = edges.join(least, "a").selectExpr("b as a", "least as b")
    own = least.selectExpr("a", "least as b")
    return moved.unionByName(own).where("a != b").unionByName(edges.where("a = b")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))")).first())
