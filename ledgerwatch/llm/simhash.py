"""SimHash fingerprints, and documents whose fingerprints differ in few bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved, small_batches, unused
from ledgerwatch.llm.components import components
from ledgerwatch.llm.groups import group_starts, whole_groups

SEED = 42  # Fixed value: seed of the shingle hash.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)

#: Shards with more distinct fingerprints than this are cut once more.
SHARD_ROWS = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of the word shingles of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digests = b"".join([xxhash.xxh64_digest(gram, SEED) for gram in grams])
    n = len(digests) // 8
    cells = np.frombuffer(digests, np.uint8).reshape(n, 8) + np.arange(0, 2048, 256)
    ones = np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ BITS
    return int.from_bytes(np.packbits(2 * ones.ravel() > n).tobytes(), "big")


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a long of the same bits."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return hashed(text)


class BKTree:
    """A Burkhard-Keller tree: children of a node are keyed by their Hamming distance to it.

    Built at once from distinct values; the tree is the one that inserting them in order gives.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        stack = [np.arange(len(values))] if len(values) else []
        while stack:
            members = stack.pop()
            node, rest = members[0], members[1:]
            if not len(rest):
                continue
            far = np.bitwise_count(values[rest] ^ values[node])
            order = np.argsort(far, kind="stable")
            for part in np.split(rest[order], np.flatnonzero(np.diff(far[order])) + 1):
                edge = int(np.bitwise_count(values[part[0]] ^ values[node]))
                self.children[node][edge] = int(part[0])
                stack.append(part)

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes, each with the positions of all queries within ``radius`` of it.

        Queries go down together, each along the edges within ``radius`` of its distance.
        """
        stack = [(0, np.arange(len(queries)))] if len(self.values) else []
        while stack:
            node, asked = stack.pop()
            far = np.bitwise_count(queries[asked] ^ self.values[node]).astype(np.int64)
            yield node, asked[far <= radius]
            for edge, child in self.children[node].items():
                goes = asked[np.abs(far - edge) <= radius]
                if len(goes):
                    stack.append((child, goes))


def shard_roots(values: np.ndarray, radius: int) -> np.ndarray:
    """For each distinct value the position of the first value that links of ``radius`` reach."""
    parent = np.arange(len(values))
    for node, near in BKTree(values).near(values, radius):
        roots = parent[near]
        while (up := parent[roots] != roots).any():
            roots[up] = parent[roots[up]]
        parent[roots] = parent[near] = roots.min()
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent


def masks(radius: int) -> list[tuple[int, list[int]]]:
    """Masks that select a shard, and for each the finer masks that cut it.

    Of ``radius + 2`` blocks of bits, two values within ``radius`` agree on at least two; so
    they share a shard of one of the pairs of blocks. The bits left over are cut likewise, so
    a finer shard leaves few bits open: 16 of 64 for a radius of two, at most 65,536 values.
    """

    def pairs(bits: list[int]) -> list[int]:
        blocks = np.array_split(bits, radius + 2)
        return [sum(1 << int(b) for block in two for b in block) for two in combinations(blocks, 2)]

    coarse = pairs(list(range(64)))
    return [(m, [m | fine for fine in pairs([b for b in range(64) if not m >> b & 1])]) for m in coarse]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _masked(all_masks: list[tuple[int, int]]) -> str:
    return "inline(array(" + ",".join(f"struct({i} as shard, fp & {_signed(m)}L as bits)" for i, m in all_masks) + "))"


def linked_fingerprints(distinct: DataFrame, radius: int) -> DataFrame:
    """``(fp, root)`` for distinct fingerprints ``fp`` that have others within ``radius`` bits.

    Fingerprints are dealt to shards by blocks of bits on which neighbours must agree; each shard is a BK-tree
    that its members search. A shard tells of each member only the first one that it is
    linked with, and the connected components of that are the result. Shards of one value are dropped
    before the trees, crowded ones are cut by finer blocks, so no shard can outgrow a task.
    """
    plan = masks(radius)
    coarse = distinct.selectExpr("fp", _masked([(i, m) for i, (m, _) in enumerate(plan)]))
    sizes = coarse.groupBy("shard", "bits").agg(F.count("*").alias("n")).where("n > 1")
    members = coarse.join(sizes, ["shard", "bits"])
    finer = " ".join(
        f"when {i} then array("
        + ",".join(f"struct({len(plan) + len(fine) * i + j} as shard, fp & {_signed(m)}L as bits)" for j, m in enumerate(fine))
        + ")"
        for i, (_, fine) in enumerate(plan)
    )
    dealt = members.selectExpr(
        "fp", f"inline(if(n <= {SHARD_ROWS}, array(struct(shard, bits)), case shard {finer} end))"
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shards in whole_groups(batches, ["shard", "bits"]):
            values = shards["fp"].to_numpy().view(np.uint64)
            starts = group_starts(shards, ["shard", "bits"])
            pairs = []
            for a, b in zip(starts, np.append(starts[1:], len(values)), strict=True):
                if b - a > 1:
                    roots = shard_roots(values[a:b], radius)
                    moved = np.flatnonzero(roots != np.arange(b - a))
                    pairs.append((values[a + moved], values[a + roots[moved]]))
            if pairs:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs, strict=True))
                yield pd.DataFrame({"a": a, "b": b})

    sorted_shards = dealt.repartition("shard", "bits").sortWithinPartitions("shard", "bits", "fp")
    edges = sorted_shards.mapInPandas(search, "a long, b long")
    return components(edges).selectExpr("node as fp", "component as root")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id among all rows that links of at most ``radius`` bits
    reach. Texts that are null, empty or blank have fingerprint zero and are linked like any
    others. A row without id takes part in links; a component without any id has the id null.
    Repeated rows give repeated results. Other columns of ``docs`` are ignored. An empty table gives no rows.
    Copies are linked through their common fingerprint and never as pairs.
    """
    rows = saved(small_batches(docs).select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")))
    ids = _component_ids(rows, radius).drop("root")
    return rows.join(ids, "fp").selectExpr(
        "doc_id", "lower(lpad(hex(fp), 16, '0')) as fingerprint", "component_id"
    )


def _component_ids(rows: DataFrame, radius: int) -> DataFrame:
    """``fp, root, component_id`` for the distinct fingerprints of ``rows(doc_id, fp)``."""
    classes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = linked_fingerprints(classes.select("fp"), radius)
    rooted = classes.join(linked, "fp", "left").selectExpr("fp", "first_id", "coalesce(root, fp) as root")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one with the smallest id.

    Of several rows with this id, and of a group without any id, the text that comes
    first in a hash order stays, and of rows equal in id and text any one. Texts are shuffled
    once, to meet the ids that stay.
    """
    mark = F.xxhash64(F.col(text))
    rows = saved(
        small_batches(docs).select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp"), mark.alias("mark"))
    )
    counted = rows.groupBy("doc_id", "fp", "mark").agg(F.count("*").alias("n"))
    stays = (
        counted.join(_component_ids(rows, radius), "fp")
        .groupBy("root")
        .agg(F.expr("min(struct(doc_id is null as none, doc_id, fp, mark, n)) as row"))
        .selectExpr("row.doc_id", "row.mark", "row.n > 1 as repeated")
    )
    own, found = F.struct(F.col(doc_id).alias("doc_id"), mark.alias("mark")), unused(docs, "found")
    stays = saved(stays.select(F.struct("doc_id", "mark", "repeated").alias(found)))

    def kept(repeated: bool) -> DataFrame:
        ids = stays.where(F.col(f"{found}.repeated") == repeated).hint("shuffle_hash")
        same = own["doc_id"].eqNullSafe(F.col(f"{found}.doc_id")) & (own["mark"] == F.col(f"{found}.mark"))
        return docs.join(ids, same, "left_semi")

    return kept(False).unionByName(kept(True).dropDuplicates([doc_id, text]))
