import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import neighbours, queries, topk

ODD = [
    (5000, None),
    (5001, [0.0] * 8),
    (5002, [float("nan")] * 8),
    (5003, [1.0, None]),
    (5004, []),
    (5005, [float("inf")] * 8),
    (None, [1.0] * 8),
]


def links(ids, vectors, threshold=0.9):
    """Number of links and smallest reachable id, by all pairs."""
    good = [k for k, v in enumerate(vectors) if v is not None and len(v) and None not in list(v) and np.isfinite(v).all() and np.any(v)]
    size = max(len(vectors[k]) for k in good)
    rows = np.stack([np.pad(np.asarray(vectors[k], float), (0, size - len(vectors[k]))) for k in good])
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    near = rows @ rows.T >= threshold
    np.fill_diagonal(near, False)
    number, least = dict.fromkeys(ids, 0), {i: i for i in ids}
    label = np.array([ids[k] for k in good])
    for _ in good:
        new = np.minimum(label, np.where(near, label[None, :], 2**62).min(axis=1))
        if (new == label).all():
            break
        label = new
    for k, n, c in zip(good, near.sum(axis=1), label, strict=True):
        number[ids[k]], least[ids[k]] = int(n), int(c)
    return number, least


def compare(frame, how=None):
    found = neighbours.near_vectors(frame, how).toPandas().set_index("vec_id")
    rows = [(r.vec_id, r.embedding) for r in frame.distinct().collect() if r.vec_id is not None]
    number, least = links([i for i, _ in rows], [v for _, v in rows])
    assert len(found) == len(rows)
    assert found.n_links.to_dict() == number and found.component_id.to_dict() == least
    assert (found.kept == (found.index == found.component_id)).all()


@pytest.fixture(scope="module")
def near(spark):
    random, rows = np.random.default_rng(3), []
    for base in random.normal(size=(40, 8)):
        base /= np.linalg.norm(base)
        for _ in range(6):
            c, z = random.uniform(0.9, 0.97), random.normal(size=8)
            z -= z @ base * base
            rows.append((c * base + np.sqrt(1 - c * c) * z / np.linalg.norm(z)) * random.uniform(0.1, 9))
        rows += [base, base.copy()]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(rows)] + ODD + [(3, [float(x) for x in rows[3]])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)


def test_near_vectors_equal_all_pairs(near):
    compare(near, neighbours.Codes(recall=0.99999))
    compare(near, neighbours.Codes(recall=0.99999, block_rows=8))


def test_near_vectors_of_the_table(spark, medium):
    compare(spark.read.parquet(f"{medium}/embeddings.parquet").select("vec_id", "embedding"))
    assert queries.op2_embeddings(spark, medium).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_recall_of_planted_pairs_at_the_registered_settings(spark):
    """1,500 pairs just above the threshold, where a hash misses most easily; no pair below it is linked."""
    random = np.random.default_rng(11)
    first = neighbours.unit(random.normal(size=(1500, 64)))
    aside = random.normal(size=first.shape)
    aside = neighbours.unit(aside - (aside * first).sum(axis=1, keepdims=True) * first)
    cosine = random.uniform(0.9005, 0.91, (1500, 1))
    second = cosine * first + np.sqrt(1 - cosine**2) * aside
    rows = [(2 * k + j, v.tolist()) for k, pair in enumerate(zip(first, second, strict=True)) for j, v in enumerate(pair)]
    found = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    linked = found.set_index("vec_id").n_links
    both = np.vstack([first, second])
    true = (both @ both.T >= 0.9).sum() - len(both)
    recall = linked.sum() / true
    print(f"recall at 0.9005 to 0.91: {recall:.4f}")
    assert 0.985 <= recall <= 1


def test_empty_and_further_columns(spark, near):
    more = near.withColumn("rep", F.lit(1)).withColumn("n", F.lit(2)).withColumn("vec", F.lit(3)).where("vec_id < 9")
    assert neighbours.near_vectors(more).count() == 9
    assert neighbours.near_vectors(near.limit(0)).count() == 0
    assert neighbours.near_vectors(near.where("vec_id >= 5000")).where("kept").count() == 6


def test_estimates_are_unbiased_and_bounded():
    random = np.random.default_rng(0)
    pair = neighbours.unit(random.normal(size=(2, 64)) + 1)
    errors, bounds = [], []
    for seed in range(300):
        turned = neighbours.rotations(64, 1, seed)
        images, signs, factors = neighbours.encode(pair, turned)
        estimate, bound = neighbours.estimates(images, signs, factors, 4.0)
        errors.append(estimate[0, 1] - pair[0] @ pair[1])
        bounds.append(bound[1])
    assert abs(np.mean(errors)) < 3 * np.std(errors) / np.sqrt(len(errors)) + 1e-3
    assert (np.abs(errors) < bounds).all()


def best(rows, k):
    out = {}
    ints = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if v is not None and None not in list(v) and np.isfinite(v).all()}
    for q in (i for i in ints if i % 20 == 0):
        dot = lambda i: sum(a * b for a, b in zip(ints[q], ints[i], strict=False))  # noqa: E731, B023
        ranked = sorted((-dot(i), i) for i in ints if i != q)[:k]
        out |= {(q, r): (i, -s) for r, (s, i) in enumerate(ranked, 1)}
    return out


def test_top_k(spark, near):
    rows = [(r.vec_id, r.embedding) for r in near.distinct().collect() if r.vec_id is not None]
    for blocks in ({}, {"block_queries": 3, "block_rows": 20}):
        found = topk.top_k(near.withColumn("score", F.lit(0)), k=5, **blocks).collect()
        assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found} == best(rows, 5)
    assert topk.top_k(near.limit(0)).count() == 0


def test_top_k_of_the_table(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in queries.op4_topk(spark, small).collect()}
    assert found == best(rows, 20)


def test_blocks_with_ties_and_huge_values():
    random = np.random.default_rng(0)
    for trial in range(12):
        # Multiples of 1/64, so that the whole numbers are the ones drawn.
        numbers = [random.integers(-4, 5, (n, 9)).astype(float) * (2.0**400 if trial % 4 == 3 else 1) for n in (7, 150)]
        (asked, rows), given = numbers, [n / topk.SCALE for n in numbers]
        ids = random.permutation(300)[:150]
        own = ids[:7]
        found = topk.best_of_block(own, given[0], ids, given[1], 5, tile=16)
        for q in range(7):
            scores = [(-sum(int(a) * int(b) for a, b in zip(asked[q], r, strict=True)), int(i)) for i, r in zip(ids, rows, strict=True)]
            expected = [(max(min(-s, topk.LONG), -topk.LONG - 1), i) for s, i in sorted(x for x in scores if x[1] != own[q])[:5]]
            mine = found[found.query_id == own[q]]
            assert list(zip(mine.score, mine.vec_id, strict=True)) == expected


def exact_best(rows, k, query=lambda i: True):
    """The best by exact whole numbers of any size."""
    whole = {i: [int(x) * 64 if abs(x) > 2.0**60 else int(np.floor(64 * x)) for x in v] for i, v in rows}
    out = {}
    for q in filter(query, whole):
        scored = [(-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q]
        out[q] = [(max(min(-s, topk.LONG), -topk.LONG - 1), i) for s, i in sorted(scored)[:k]]
    return out


def test_finite_vectors_of_any_size(spark):
    """Components up to the largest double: no row vanishes, and sums beyond a long are ranked by what they are."""
    random = np.random.default_rng(7)
    rows = [(i, random.normal(size=4).tolist()) for i in range(60)]
    big = [1e160, -1e160, 1e307, -1e307, 1.7e308, 5e-324, 1e18, 3e17, 2.0**53 + 2, 1e9]
    rows += [(100 + i, [x, 1.0, -x if i % 2 else 0.0, float(i)]) for i, x in enumerate(big)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for blocks in ({}, {"block_queries": 5, "block_rows": 7}):
        found = topk.top_k(frame, queries="vec_id >= 0", k=6, **blocks).orderBy("query_id", "rank").collect()
        mine = {}
        for r in found:
            mine.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert mine == exact_best(rows, 6)


def test_bounds_leave_out_most_pairs_of_clustered_vectors():
    random = np.random.default_rng(8)
    centres = random.normal(size=(40, 64)) * 3
    rows = np.repeat(centres, 100, axis=0) + random.normal(size=(4000, 64)) * 0.2
    ids, products = random.permutation(4000), []
    asked = ids[:50]
    found = topk.best_of_block(asked, rows[:50], ids, rows, 10, tile=256, products=products)
    whole = np.floor(64 * rows).astype(np.int64)
    for q in range(50):
        scores = whole @ whole[q]
        expected = sorted((-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if i != asked[q])[:10]
        mine = found[found.query_id == asked[q]]
        assert [(-s, i) for s, i in zip(mine.score, mine.vec_id, strict=True)] == expected
    pairs, exact = products
    print(f"exact products: {exact} of {pairs}")
    assert exact < 0.5 * pairs


def test_open_pairs_keep_whatever_may_be_best():
    random = np.random.default_rng(9)
    q, r = random.normal(size=(30, 24)), random.normal(size=(200, 24)) + random.normal(size=(200, 1)) * 2
    levels = topk.resolutions(24)
    stats = [[topk.segment_statistics(m, n) for n in levels] for m in (q, r)]
    products = q @ r.T
    for share in (0.5, 0.9, 0.99):
        level = np.quantile(products, share, axis=1)
        open_ = topk.open_pairs(*stats, level, np.full(30, 1e-9))
        assert open_[products > level[:, None]].all() and (share < 0.9 or open_.mean() < 1)


def test_invalid_vectors_of_an_id_do_not_hide_valid_ones(spark):
    rows = [(1, [None, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [None, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.near_vectors(frame).toPandas().set_index("vec_id")
    assert found.n_links.to_dict() == {1: 1, 2: 1, 3: 0} and found.component_id.to_dict() == {1: 1, 2: 1, 3: 3}
    pairs = {(r.query_id, r.vec_id) for r in topk.top_k(frame, queries="vec_id > 0", k=2).collect()}
    assert pairs == {(1, 2), (2, 1)}
