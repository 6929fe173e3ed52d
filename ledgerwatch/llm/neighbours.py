"""Near-duplicate vectors: binary codes of random rotations, and exact products where the codes leave doubt."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved
from ledgerwatch.llm.components import components
from ledgerwatch.llm.groups import block_pairs, first_of_links, group_starts, whole_groups
from ledgerwatch.llm.vectors import FINITE, dimension, matrix, one_per_id


@dataclass(frozen=True)
class Codes:
    """How vectors are coded and how candidates are found.

    ``bits`` is the length of a code; confidence bounds are ``deviations`` standard deviations wide.
    Candidates share one of several hash keys; keys are so long that about ``bucket`` unrelated
    vectors share one, and there are so many that a pair at the threshold shares one with a chance
    of ``recall``.
    """

    threshold: float = 0.9
    bits: int = 256
    deviations: float = 4.0
    bucket: float = 8.0
    recall: float = 0.99
    block_rows: int = 1024
    seed: int = 42

    def keys(self, n: int) -> tuple[int, int]:
        """Bits of a key, at most 63, and number of keys, for ``n`` vectors."""
        bits = min(63, max(8, ceil(log2(max(2, n / self.bucket)))))
        agree = (1 - acos(self.threshold) / pi) ** bits
        return bits, ceil(log(1 - self.recall) / log(1 - agree))


def rotations(dim: int, number: int, seed: int) -> np.ndarray:
    """Random rotations: (number, dim, dim)."""
    random = np.random.default_rng(seed)
    out = np.empty((number, dim, dim))
    for k in range(number):
        q, r = np.linalg.qr(random.normal(size=(dim, dim)))
        out[k] = q * np.sign(np.diag(r))
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True)  # first, so that no square overflows
    scaled = rows / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(rows: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of unit vectors: their images ``(n, rotation, dim)``, the signs, and the correction factors.

    The code of a vector o is the corner of a cube, ``sign(P o) / sqrt(d)``, for each rotation P.
    The factor is the inner product of corner and image. For any unit q the inner product of corner
    and ``P q``, divided by the factor, is an unbiased estimate of that of o and q.
    """
    images = np.einsum("nd,rde->nre", rows, turned)
    signs = images > 0
    return images, signs, np.abs(images).sum(axis=2) / sqrt(rows.shape[1])


def estimates(images: np.ndarray, signs: np.ndarray, factors: np.ndarray, deviations: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries, coded), the mean over the rotations, and a bound of the error
    for each coded vector.
    """
    n, number, dim = signs.shape
    corners = (2.0 * signs - 1) / (sqrt(dim) * factors[:, :, None] * number)
    estimate = images.reshape(len(images), -1) @ corners.reshape(n, -1).T
    variance = np.maximum(0, 1 - factors**2) / factors**2 / max(1, dim - 1)
    return estimate, deviations * np.sqrt(variance.sum(axis=1)) / number


def links(low: np.ndarray, high: np.ndarray | None, coded: tuple, how: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions with a cosine from the threshold on, among ``low`` or between ``low`` and
    ``high``.

    ``coded`` are signs and factors of what is searched. What the estimate and its bound rule out is
    not looked at again; all other pairs get their exact product.
    """
    searched = low if high is None else high
    turned, signs, factors = coded
    images = np.einsum("nd,rde->nre", low, turned)
    estimate, bound = estimates(images, signs, factors, how.deviations)
    doubt = estimate + bound[None, :] >= how.threshold
    if high is None:
        doubt &= np.arange(len(low))[:, None] < np.arange(len(low))
    if doubt.mean() > 0.1:
        return np.nonzero(doubt & (low @ searched.T >= how.threshold))
    i, j = np.nonzero(doubt)
    near = np.einsum("nd,nd->n", low[i], searched[j]) >= how.threshold
    return i[near], j[near]


def coded_classes(vectors: DataFrame, dim: int, n: int, how: Codes) -> DataFrame:
    """``rep, copies, vec, code, factors, keys`` for distinct vectors ``rep, copies, vec``."""
    key_bits, n_keys = how.keys(n)
    of_code = -(-how.bits // dim)
    number = of_code + -(-key_bits * n_keys // dim)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turned = rotations(dim, number, how.seed)
        powers = 2 ** np.arange(key_bits, dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            _, signs, factors = encode(unit(matrix(batch["vec"], dim)), turned)
            packed = np.packbits(signs[:, :of_code].reshape(len(batch), -1), axis=1)
            drawn = signs[:, of_code:].reshape(len(batch), -1)[:, : key_bits * n_keys]
            keys = drawn.reshape(len(batch), n_keys, key_bits) @ powers
            yield batch.assign(
                code=[c.tobytes() for c in packed], factors=list(factors[:, :of_code]), keys=list(keys)
            )

    schema = "rep long, copies long, vec array<double>, code binary, factors array<double>, keys array<long>"
    return vectors.mapInPandas(code, schema)


def coarse_edges(classes: DataFrame, how: Codes, dim: int) -> DataFrame:
    """``a, b``: links that hold together at least all pairs whose codes cannot rule them out.

    Vectors meet by hash key. Of each bucket only codes travel, and what comes back links each
    vector with one other.
    """
    bits = dim * -(-how.bits // dim)
    p = acos(how.threshold) / pi
    most = bits * p + how.deviations * sqrt(bits * p * (1 - p))
    rows = classes.selectExpr("rep", "code", "posexplode(keys) as (table, key)")
    place = ["table", "key", "low", "high"]

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in whole_groups(batches, place):
            raw = np.frombuffer(b"".join(chunk["code"]), np.uint8).reshape(len(chunk), -1)
            raw = np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8)))
            codes = np.ascontiguousarray(raw).view(np.uint64)
            group = np.zeros(len(chunk), np.int64)
            group[group_starts(chunk, place)[1:]] = 1
            group = np.cumsum(group)
            block, low, high = (chunk[c].to_numpy() for c in ("block", "low", "high"))
            within = low == high
            first, left, right, held = np.arange(len(chunk)), [], [], 0
            at = np.arange(len(chunk))
            for step in range(1, len(chunk)):
                at = at[at + step < len(chunk)]
                at = at[group[at] == group[at + step]]
                if not len(at):
                    break
                asked = at[within[at] | (block[at] != block[at + step])]
                near = asked[np.bitwise_count(codes[asked] ^ codes[asked + step]).sum(axis=1) <= most]
                left.append(near)
                right.append(near + step)
                held += len(near)
                if held > 2_000_000:
                    a, b = np.concatenate([*left, np.arange(len(chunk))]), np.concatenate([*right, first])
                    first = first_of_links(len(chunk), a, b)
                    left, right, held = [], [], 0
            a = np.concatenate([*left, np.arange(len(chunk))])
            b = np.concatenate([*right, first])
            first = first_of_links(len(chunk), a, b)
            moved = np.flatnonzero(first != np.arange(len(chunk)))
            ids = chunk["rep"].to_numpy()
            yield pd.DataFrame({"a": ids[moved], "b": ids[first[moved]]}).drop_duplicates()

    return block_pairs(rows, ["table", "key"], "rep", how.block_rows * 2).mapInPandas(meet, "a long, b long")


def exact_links(members: DataFrame, how: Codes, dim: int) -> DataFrame:
    """Of vectors in coarse groups ``(root, rep, copies, vec, code, factors)``: per vector and place
    ``a`` the number ``n`` of vectors it is linked with, and links ``a, b`` (``n`` null) that hold
    the linked ones together.
    """
    place = ["root", "low", "high"]
    of_code = -(-how.bits // dim)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turned = rotations(dim, of_code, how.seed)
        for chunk in whole_groups(batches, place):
            starts = group_starts(chunk, place)
            ids, copies = chunk["rep"].to_numpy(), chunk["copies"].to_numpy()
            rows = unit(matrix(chunk["vec"], dim))
            packed = np.frombuffer(b"".join(chunk["code"]), np.uint8).reshape(len(chunk), -1)
            signs = np.unpackbits(packed, axis=1, count=of_code * dim).reshape(len(chunk), of_code, dim)
            factors = np.stack(chunk["factors"].to_list())
            block, low, high = (chunk[c].to_numpy() for c in ("block", "low", "high"))
            counted, out = np.zeros(len(chunk), np.int64), []
            for s, e in zip(starts, np.append(starts[1:], len(chunk)), strict=True):
                cut = e if low[s] == high[s] else s + np.searchsorted(block[s:e], high[s])
                other = slice(s, e) if cut == e and low[s] == high[s] else slice(cut, e)
                if cut == s or other.start == e or e - s < 2:
                    continue
                within = low[s] == high[s]
                i, j = links(
                    rows[s:cut], None if within else rows[other], (turned, signs[other], factors[other]), how
                )
                i, j = i + s, j + other.start
                np.add.at(counted, i, copies[j])
                np.add.at(counted, j, copies[i])
                first = first_of_links(e - s, i - s, j - s)
                moved = np.flatnonzero(first != np.arange(e - s))
                out.append((ids[s + moved], ids[s + first[moved]]))
            some = np.flatnonzero(counted)
            yield pd.DataFrame({"a": ids[some], "b": pd.array([None] * len(some), "Int64"), "n": pd.array(counted[some], "Int64")})
            if out:
                a, b = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"a": a, "b": pd.array(b, "Int64"), "n": pd.array([None] * len(a), "Int64")})

    return block_pairs(members, ["root"], "rep", how.block_rows).mapInPandas(search, "a long, b long, n long")


def near_vectors(vectors: DataFrame, how: Codes | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every id of ``vectors(vec_id, embedding)``.

    Two vectors are linked if their cosine, in double precision, is at least the threshold.
    ``n_links`` counts the other vectors linked directly, copies included; ``component_id`` is the
    smallest id that links reach. Vectors that are null, zero or empty or hold null or non-finite
    components are linked with nothing. Of rows that share an id the smallest valid vector counts; rows
    without id are left out; a shorter vector is filled with zeros. Other columns are ignored. An empty table gives no rows.

    Exact copies are one vector with a count. Hash keys made of code bits find candidates, codes
    keep those that may be near and hold them together in coarse groups; within a group, which has
    all possible links of its members that were found, estimates with correction factors rule pairs
    out, and the rest is computed exactly. Large buckets and groups are split into pairs of blocks.
    """
    how = how or Codes()
    usable = f"{FINITE} and exists(vec, x -> x != 0)"
    rows = saved(one_per_id(vectors, valid=usable))
    valid = rows.where(f"vec is not null and {usable}")
    classes = saved(valid.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    members = valid.join(classes, "vec").select("vec_id", "rep", "copies")
    n, dim = classes.count(), dimension(classes)
    if not n:
        alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    coded = saved(coded_classes(classes.select("rep", "copies", "vec"), dim, n, how))
    groups = components(coarse_edges(coded, how, dim)).selectExpr("node as rep", "component as root")
    grouped = saved(coded.drop("keys").join(groups, "rep"))
    found = saved(exact_links(grouped, how, dim))
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "rep")
    joined = components(found.where("b is not null").select("a", "b")).selectExpr("node as rep", "component")
    return (
        rows.select("vec_id")
        .join(members, "vec_id", "left")
        .join(counts, "rep", "left")
        .join(joined, "rep", "left")
        .selectExpr(
            "vec_id",
            "coalesce(n, 0) + coalesce(copies - 1, 0) as n_links",
            "coalesce(component, rep, vec_id) as component_id",
        )
        .selectExpr("*", "vec_id = component_id as kept")
    )
