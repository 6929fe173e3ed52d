"""A dataset manifest as a content-addressed tree of digests, with a proof of inclusion for each row.

A digest names a node; a record holds the digests of its children. Records are stored in pages: the
records of a few levels below one digest, found by that digest. A request for a leaf starts at the
root and follows the digits of the leaf's rank from page to page, collecting the children that it
does not select. Read from the leaf to the root, these are its proof.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved

#: Levels of the tree whose records lie in one page.
PAGE_LEVELS = 5
SEGMENT = "struct<left:string,right:string>"
RECORD = "struct<digest:string,children:array<string>>"


def field(value: str) -> str:
    """SQL for a value as part of a leaf: its UTF-8 bytes counted, then the value; ``-`` for null."""
    text = f"cast({value} as string)"
    return f"coalesce(concat(cast(octet_length({text}) as string), ':', {text}), '-')"


def leaf_digest(values: list[str]) -> str:
    """SQL for the digest of a row of ``values`` (SQL expressions)."""
    return f"sha2(concat({', '.join(map(field, values))}), 256)"


def folded(leaf: str, path: str = "path") -> str:
    """SQL for the root that follows from a leaf's digest and its proof."""
    return f"aggregate({path}, {leaf}, (node, part) -> sha2(concat(part.left, node, part.right), 256))"


def proof_digest(path: str = "path") -> str:
    """SQL for the digest of a whole proof."""
    return f"sha2(array_join(transform({path}, part -> concat(part.left, part.right)), ''), 256)"


@dataclass(frozen=True)
class Tree:
    """Trees over ranked nodes.

    ``nodes(tree, rank, depth, digest, ...)`` are the leaves, ``roots(tree, depth, digest)`` what remains of each
    tree, ``pages[p](digest, records)`` the pages that are ``p`` pages above the leaves, each once.
    """

    nodes: DataFrame
    roots: DataFrame
    pages: list[DataFrame]
    fanout: int

    def page_nodes(self) -> int:
        return self.fanout**PAGE_LEVELS


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``rank`` (from 0) in their ``tree`` by ``order``, which must tell rows apart, and the
    number ``n`` of the tree's rows.

    Rows are dealt and sorted by range; a row's rank is its place in its partition and the number of the
    tree's rows in the partitions before, so no task holds more than its range whatever a tree's size.
    """
    key = ["tree", *order]
    placed = saved(
        rows.repartitionByRange(*key).sortWithinPartitions(*key).selectExpr("*", "monotonically_increasing_id() as place")
    ).selectExpr("*", "shiftright(place, 33) as part")
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = "partition by tree order by part rows between unbounded preceding and 1 preceding"
    starts = parts.selectExpr(
        "tree", "part", f"first - coalesce(sum(n) over ({before}), 0) as start", "sum(n) over (partition by tree) as n"
    )
    return placed.join(starts, ["tree", "part"]).selectExpr(*rows.columns, "place - start as rank", "n")


def build(nodes: DataFrame, fanout: int = 2) -> Tree:
    """The trees over ``nodes(tree, rank, n, digest, ...)`` as ``ranked`` gives them: each ``fanout`` consecutive nodes become the digest
    of their digests joined, level by level, until one remains. A lone node remains as it is.
    """
    wide = fanout**PAGE_LEVELS
    # A tree of n leaves has as many levels as n - 1 has digits.
    depth = f"if(n > 1, length(conv(n - 1, 10, {fanout})), 0) as depth"
    nodes = saved(nodes.selectExpr("*", depth).drop("n"))
    deepest, level, pages = nodes.agg(F.max("depth")).first()[0] or 0, nodes, []
    # Records of one level follow from the one below, whose records lie last in ``levels``.
    runs = f"""transform(sequence(0, (size(element_at(levels, -1)) - 1) div {fanout}),
        j -> transform(slice(element_at(levels, -1), cast(j * {fanout} + 1 as int), {fanout}), child -> child.digest))"""
    record = "run -> named_struct('digest', sha2(array_join(run, ''), 256), 'children', run)"
    leaves = f"transform(children, c -> cast(struct(c.digest, null) as {RECORD}))"
    roots = [level.where("depth = 0").select("tree", "depth", "digest")]
    for below in range(0, deepest, PAGE_LEVELS):
        grouped = (
            level.where(f"depth > {below}")
            .groupBy("tree", "depth", F.expr(f"rank div {wide} as page"))
            .agg(F.expr("array_sort(collect_list(struct(rank, digest))) as children"))
        )
        levels = f"""aggregate(sequence(1, least({PAGE_LEVELS}, depth - {below})), array({leaves}),
            (levels, i) -> concat(levels, array(transform({runs}, {record}))))"""
        page = saved(
            grouped.selectExpr("tree", "depth", "page as rank", f"{levels} as levels").selectExpr(
                "tree", "depth", "rank", "element_at(levels, -1)[0].digest as digest",
                f"map_from_entries(array_distinct(flatten(slice(levels, 2, {PAGE_LEVELS})))) as records",
            )
        )
        # The same digest stands for the same records: one page is enough.
        pages.append(page.groupBy("digest").agg(F.expr("any_value(records) as records")))
        level = page.select("tree", "depth", "rank", "digest")
        roots.append(level.where(f"depth <= {below + PAGE_LEVELS}").select("tree", "depth", "digest"))
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return Tree(nodes, saved(every), pages, fanout)


def descend(tree: Tree, tops: DataFrame, requests: DataFrame) -> DataFrame:
    """The ``requests(tree, rank, ...)`` with ``reached``, the digest found for them, and ``path``, the
    parts that were not selected from the root down.

    ``tops(tree, depth, digest, path)`` says where each tree begins, and what was collected above it.
    Requests that go through the same pages go together: a page is looked up once.
    """
    wide, fanout = tree.page_nodes(), tree.fanout
    wanted = [requests]
    for _ in tree.pages[1:]:
        # The pages that are wanted are the nodes that are wanted one page above.
        wanted.append(wanted[-1].selectExpr("tree", f"rank div {wide} as rank").distinct())
    power = f"element_at(array({', '.join(f'{fanout**i}L' for i in range(PAGE_LEVELS))}), i)"
    digit = f"cast(local div {power} % {fanout} as int)"
    children = "element_at(records, at.node)"
    part = f"""named_struct('left', array_join(slice({children}, 1, {digit}), ''),
        'right', array_join(slice({children}, {digit} + 2, {fanout}), ''))"""
    walk = f"""aggregate(sequence(steps, 1, -1), named_struct('node', top, 'path', above),
        (at, i) -> named_struct('node', get({children}, {digit}), 'path', concat(at.path, array({part})))) as at"""
    frontier = walked = None
    for p in reversed(range(len(tree.pages))):
        below = p * PAGE_LEVELS
        start = tops.where(f"depth > {below} and depth <= {below + PAGE_LEVELS}").selectExpr(
            "tree", "depth", "0L as page", "digest as top", "path as above"
        )
        frontier = saved(start if frontier is None else start.unionByName(frontier))
        found = frontier.join(tree.pages[p].withColumnRenamed("digest", "top"), "top")
        rows = wanted[p].selectExpr("*", f"rank div {wide} as page", f"rank % {wide} as local")
        walked = rows.join(found, ["tree", "page"]).selectExpr("*", f"least({PAGE_LEVELS}, depth - {below}) as steps")
        walked = walked.selectExpr(*wanted[p].columns, "depth", walk)
        frontier = walked.selectExpr("tree", "depth", "rank as page", "at.node as top", "at.path as above")
    lone = tops.where("depth = 0").selectExpr("tree", "digest as reached", "path")
    done = requests.join(lone, "tree").select(*requests.columns, "reached", "path")
    if walked is None:
        return done
    return walked.selectExpr(*requests.columns, "at.node as reached", "at.path as path").unionByName(done)


@dataclass(frozen=True)
class Manifest:
    """The trees of a dataset and the tree over their roots; ``root`` names all of it."""

    leaves: Tree
    trees: Tree

    def root(self) -> DataFrame:
        """One row with the ``root``; none for a dataset without rows."""
        return self.trees.roots.selectExpr("digest as root")

    def records(self) -> DataFrame:
        """``(digest, children)`` of all inner nodes, each once."""
        pages = [*self.leaves.pages, *self.trees.pages]
        entries = [p.selectExpr("explode(records) as (digest, children)") for p in pages]
        if not entries:
            return self.trees.roots.selectExpr("digest", "array(digest) as children").limit(0)
        every = entries[0]
        for more in entries[1:]:
            every = every.unionByName(more)
        return every.dropDuplicates(["digest"])


def manifest(rows: DataFrame, tree: str, order: str, leaf: str, fanout: int = 2, keep: tuple[str, ...] = ()) -> Manifest:
    """The manifest of ``rows``: a tree for each value of ``tree``, whose leaves ascend by ``order``, and a
    tree over their roots by that value.

    All are SQL expressions over ``rows``; ``leaf`` gives a row's digest, ``keep`` (``... as name``) what goes
    along with the leaves; ``fanout`` is 2 to 36. Null trees come first, null orders too; rows of the same order go by their
    digest, and equal rows are leaves of their own. An empty table has no root and no trees.
    """
    narrow = rows.selectExpr(
        # A value of its own for null, which sorts in front; texts are compared byte by byte.
        f"coalesce(concat('=', cast({tree} as string)), '-') as tree",
        f"{order} as item",
        f"{leaf} as digest",
        *keep,
        "monotonically_increasing_id() as row",
    )
    leaves = build(ranked(saved(narrow), ["item", "digest", "row"]).drop("row"), fanout)
    roots = leaves.roots.selectExpr("'' as tree", "tree as name", "digest")
    return Manifest(leaves, build(ranked(roots, ["name"]), fanout))


def proofs(of: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves with their ``subroot``, the ``root``, and ``path``: an array of ``left`` and ``right``, the
    digests joined that stand beside the node on each level from the leaf to the root.

    ``requests`` are rows of ``of.leaves.nodes``, all by default. Each is looked up from the root down;
    ``reached`` is the digest at which it arrives.
    """
    requests = (of.leaves.nodes if requests is None else requests).drop("depth")
    top = of.trees.roots.selectExpr("tree", "depth", "digest", f"cast(array() as array<{SEGMENT}>) as path")
    asked = of.trees.nodes.join(requests.selectExpr("tree as name").distinct(), "name", "left_semi")
    begun = saved(descend(of.trees, top, asked.select("tree", "rank", "name")))
    tops = of.leaves.roots.join(begun.selectExpr("name as tree", "reached", "path"), "tree")
    # What is reached is where the search goes on: the root of that tree, as the manifest has it.
    found = descend(of.leaves, tops.selectExpr("tree", "depth", "reached as digest", "path"), requests)
    roots = begun.join(of.trees.roots.selectExpr("tree", "digest as root"), "tree")
    ends = roots.selectExpr("name as tree", "reached as subroot", "root")
    return found.join(ends, "tree").withColumn("path", F.expr("reverse(path)"))
