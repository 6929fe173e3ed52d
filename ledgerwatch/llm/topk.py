"""Exact top-k search by inner product, with bounds from segment statistics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved
from ledgerwatch.llm.vectors import FINITE, dimension, matrix, one_per_id

SCALE = 64
EXACT = 2.0**53
LONG = 2**63 - 1
#: Doubles beyond this have no digits behind the point.
LARGE = 2.0**60
#: Pairs that are multiplied one by one at a time.
PAIRS = 1 << 16


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Per segment the mean and the deviation, scaled so that the product of two such rows bounds the
    inner product.

    With segments of width w, means m and deviations s (roots of the summed squares about the mean),
    the squared distance of q and x is at least the sum of ``w (mq - mx)^2 + (sq - sx)^2``. The
    inner product is half of what the squared lengths exceed the squared distance by, so it is at
    most the sum of ``w mq mx + sq sx``.
    """
    n, dim = rows.shape
    width = -(-dim // segments)
    padded = np.zeros((n, segments, width))
    padded.reshape(n, -1)[:, :dim] = rows
    mean = padded.mean(axis=2)
    deviation = np.sqrt(np.square(padded - mean[:, :, None]).sum(axis=2))
    return np.hstack([mean * np.sqrt(width), deviation])


def resolutions(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16, ... below the dimension."""
    return [4**k for k in range(16) if 4**k < dim]


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    """``floor(64 * x)`` of doubles as floats; infinite where that is larger than any."""
    with np.errstate(over="ignore"):
        return np.floor(SCALE * rows)


def plain(rows: np.ndarray, dim: int) -> np.ndarray:
    """Which rows of whole numbers are so small that floats add up their products exactly."""
    return np.abs(rows).max(axis=1, initial=0) <= np.sqrt(EXACT / max(1, dim))


def digits(rows: np.ndarray) -> np.ndarray:
    """``floor(64 * x)`` of doubles of any size as whole numbers of any length."""
    out = np.empty(rows.shape, object)
    for k, x in enumerate(rows.ravel().tolist()):
        out.flat[k] = int(x) * SCALE if abs(x) > LARGE else math.floor(SCALE * x)
    return out


def open_pairs(queries: list[np.ndarray], rows: list[np.ndarray], level: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Which pairs of a query and a row have a bound above the query's ``level``, from coarse statistics to fine ones.

    A finer bound is computed for pairs that are still open only: for all at once while these are many, else one by one.
    """
    open_ = queries[0] @ rows[0].T + slack[:, None] > level[:, None]
    for q, x in zip(queries[1:], rows[1:], strict=True):
        if 4 * open_.sum() > open_.size:
            open_ &= q @ x.T + slack[:, None] > level[:, None]
            continue
        i, j = np.nonzero(open_)
        for a in range(0, len(i), PAIRS):
            part = slice(a, a + PAIRS)
            above = np.einsum("ps,ps->p", q[i[part]], x[j[part]]) + slack[i[part]] > level[i[part]]
            open_[i[part][~above], j[part][~above]] = False
    return open_


def beyond(score: int) -> str:
    """A text that sorts like the scores that are cut to the same end of a long: number of digits, then digits."""
    if score >= LONG:
        return f"{len(str(score)):05}{score}"
    if score <= -LONG - 1:
        text = str(-score)
        return f"{99_999 - len(text):05}" + "".join(str(9 - int(c)) for c in text)
    return ""


class Best:
    """The ``k`` best rows of each query so far, by score and then smaller id."""

    def __init__(self, k: int, n_queries: int):
        self.k, self.found = k, pd.DataFrame({"q": [], "score": [], "beyond": [], "vec_id": []})
        self.level = np.full(n_queries, -np.inf)  # not above the k-th score

    def add(self, q: np.ndarray, scores: np.ndarray, vec_id: np.ndarray) -> None:
        if scores.dtype == object:
            cut = np.array([min(max(v, -LONG - 1), LONG) for v in scores], np.int64)
            new = {"q": q, "score": cut, "beyond": [beyond(v) for v in scores], "vec_id": vec_id}
        else:
            new = {"q": q, "score": scores.astype(np.int64), "beyond": "", "vec_id": vec_id}
        new = pd.DataFrame(new)
        both = pd.concat([self.found, new], ignore_index=True) if len(self.found) else new
        by = ["q", "score", "beyond", "vec_id"]
        both = both.sort_values(by, ascending=[True, False, False, True], kind="stable").groupby("q").head(self.k)
        self.found = both
        last = both.groupby("q")["score"].agg(["size", "last"])
        last = last[last["size"] == self.k]
        self.level[last.index.to_numpy().astype(int)] = np.nextafter(last["last"].to_numpy().astype(float), -np.inf)


def best_of_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, tile: int = 1024,
    products: list[int] | None = None,
) -> pd.DataFrame:
    """The ``k`` best of ``rows`` (doubles) for each query, by score and then smaller id.

    Candidates are looked at tile by tile, those with the largest bounds for any query first, so that the ``k``-th scores
    are high soon. Pairs whose bound is not above the query's ``k``-th score so far are dropped at the coarsest
    resolution that shows it; only the others get their exact score. Pairs with a number too large for exact sums
    of floats are multiplied in whole numbers of any length. ``products`` gets the numbers of pairs and of exact scores.
    """
    dim = rows.shape[1]
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    whole_q, whole_r = whole_numbers(queries), whole_numbers(rows)
    plain_q, plain_r = plain(whole_q, dim), plain(whole_r, dim)
    best, exact = Best(k, len(queries)), 0
    # What floats cannot add up: every pair with a large number, exactly.
    for some_q, some_r in ((~plain_q, np.ones(len(ids), bool)), (plain_q, ~plain_r)):
        asked, part = np.flatnonzero(some_q), np.flatnonzero(some_r)
        for a in range(0, len(part) if len(asked) else 0, tile):
            some = part[a : a + tile]
            scores = digits(queries[asked]) @ digits(rows[some]).T
            exact += scores.size
            i, j = np.nonzero(query_ids[asked, None] != ids[None, some])
            best.add(asked[i], scores[i, j], ids[some[j]])
    asked, part = np.flatnonzero(plain_q), np.flatnonzero(plain_r)
    if len(asked) and len(part):
        q, r = whole_q[asked], whole_r[part]
        levels = resolutions(dim) or [1]
        of_queries, of_rows = ([segment_statistics(m, n) for n in levels] for m in (q, r))
        slack = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(r, axis=1).max(initial=0) + 1e-6
        # Rows with large bounds come first; the statistics of all queries stand for them as a box.
        top = np.maximum(of_queries[-1].max(axis=0) * of_rows[-1], of_queries[-1].min(axis=0) * of_rows[-1]).sum(axis=1)
        order = np.argsort(-top, kind="stable")
        for a in range(0, len(order), tile):
            some = order[a : a + tile]
            level = best.level[asked]
            open_ = open_pairs(of_queries, [x[some] for x in of_rows], level, slack)
            if 4 * open_.sum() > open_.size:
                scores = q @ r[some].T
                open_ &= scores >= level[:, None]
                i, j = np.nonzero(open_ & (query_ids[asked, None] != ids[None, part[some]]))
                found, exact = scores[i, j], exact + scores.size
            else:
                i, j = np.nonzero(open_ & (query_ids[asked, None] != ids[None, part[some]]))
                exact += len(i)
                parts = [np.einsum("ps,ps->p", q[i[b : b + PAIRS]], r[some[j[b : b + PAIRS]]]) for b in range(0, len(i), PAIRS)]
                found = np.concatenate([np.zeros(0), *parts])
            if len(i):
                best.add(asked[i], found, ids[part[some[j]]])
    if products is not None:
        products += [len(queries) * len(ids), exact]
    found = best.found
    return pd.DataFrame(
        {
            "query_id": query_ids[found["q"].to_numpy().astype(int)],
            "score": found["score"].to_numpy().astype(np.int64),
            "beyond": found["beyond"].to_numpy(),
            "vec_id": found["vec_id"].to_numpy(),
        }
    )


def top_k(
    vectors: DataFrame,
    queries: str = "vec_id % 20 = 0",
    k: int = 20,
    block_queries: int = 16_384,
    block_rows: int = 8_192,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets ``queries`` the ``k`` others with the
    highest score.

    The score is the inner product of ``floor(64 * x)``, exact; ties go to the smaller id. Vectors
    that are null or hold null or non-finite components take no part, nor do rows without id; of
    rows that share an id the smallest valid vector counts; a shorter vector is filled with zeros; a sum
    beyond a long is cut to its ends, and ranked by its exact value. Other columns are ignored. An empty table gives no rows.

    Each block of queries meets each block of candidates in one task; a task returns ``k`` rows per
    query and block.
    """
    rows = saved(one_per_id(vectors).where(f"vec is not null and {FINITE}"))
    asked = rows.where(queries)
    n_rows, n_queries, dim = rows.count(), asked.count(), dimension(rows)
    row_blocks, query_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // block_queries))
    mark = "xxhash64(vec_id)"
    left = asked.selectExpr(
        "vec_id", "vec", f"cast(pmod({mark}, {query_blocks}) as int) as q", f"explode(sequence(0, {row_blocks - 1})) as c"
    )
    right = rows.selectExpr(
        "vec_id", "vec", f"explode(sequence(0, {query_blocks - 1})) as q", f"cast(pmod({mark}, {row_blocks}) as int) as c"
    )

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        asked, others = (matrix(side["vec"], dim) for side in (queries, candidates))
        return best_of_block(queries["vec_id"].to_numpy(), asked, candidates["vec_id"].to_numpy(), others, k)

    found = (
        left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(meet, "query_id long, score long, beyond string, vec_id long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
    )
