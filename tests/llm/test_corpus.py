"""Operators over the whole corpus, and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwatch.llm import components, language, mixing, packing, queries, secrets, simhash
from tests.compare import assert_same, connect
from tests.llm.conftest import TEXTS


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in low).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(values, radius=2):
    """Position of the first value that links reach, for each value."""
    first = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    while True:
        new = np.array([first[n].min() for n in near])
        if (new == first).all():
            return first
        first = new


def slow_components(rows):
    """Per row the fingerprint and the smallest id of its component."""
    values = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    groups = slow_groups(values)
    least = {g: min((i for k, (i, _) in enumerate(rows) if groups[k] == g and i is not None), default=None) for g in groups}
    return [(i, f"{v:016x}", least[g]) for (i, _), v, g in zip(rows, values, groups, strict=True)]


def key(row):
    return tuple((x is None, x) for x in row)


def test_simhash(spark, small, odd, none):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for frame in (docs, odd):
        expected = slow_components([tuple(r) for r in frame.select("doc_id", "text").collect()])
        found = [tuple(r) for r in simhash.near_duplicates(frame).collect()]
        assert sorted(found, key=key) == sorted(expected, key=key)
    assert simhash.near_duplicates(none).count() == 0


def test_crowded_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 20)
    draw, values = random.Random(1), set()
    for base in [draw.getrandbits(64) for _ in range(3)]:
        values |= {base ^ sum(1 << b for b in set(draw.choices(range(64), k=draw.randrange(7)))) for _ in range(400)}
    values = np.array(sorted(values), np.uint64)
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    roots = dict(simhash.linked_fingerprints(rows, 2).collect())
    mine = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    slow = slow_groups(values)
    assert len(set(zip(mine, slow, strict=True))) == len(set(mine)) == len(set(slow))


def test_tree_follows_all_edges_within_the_radius():
    values = np.unique(np.random.default_rng(0).integers(0, 2**9, 200).astype(np.uint64))
    tree = simhash.BKTree(values)
    assert sum(map(len, tree.children)) == len(values) - 1
    for node, children in enumerate(tree.children):
        assert all(np.bitwise_count(values[node] ^ values[c]) == d for d, c in children.items())
    found = {(node, int(q)) for node, near in tree.near(values, 2) for q in near}
    assert found == {(a, b) for a in range(len(values)) for b in range(len(values)) if bin(int(values[a] ^ values[b])).count("1") <= 2}


def test_one_row_of_each_group_stays(spark, odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    expected = {c for _, _, c in slow_components(rows) if c is not None}
    assert {i for i in ids if i is not None} == expected and all(ids[i] == 1 for i in expected)
    assert ids[None] == 1  # the text without id that has no near duplicate with one
    assert simhash.drop_near_duplicates(none).count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(k, 500) for k in range(480, 500)] + [(7, 3), (3, 9), (9, 7), (1, 1)]
    found = dict(components.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    expected = dict.fromkeys(range(100, 161), 100) | dict.fromkeys(range(480, 501), 480) | dict.fromkeys([3, 7, 9], 3) | {1: 1}
    assert found == expected


def slow_pack(items, opened, permitted, cost):
    bins, out, histogram = [], [], Counter(items)
    for length in sorted(items, reverse=True):
        fits = [k for k, (size, content) in enumerate(bins) if size - content >= length]
        if fits:
            k = min(fits, key=lambda k: (bins[k][0] - bins[k][1], k))
        else:
            smaller = sum(n * c for n, c in histogram.items() if n <= length)
            bins.append([min((s for s in opened if s >= length), key=lambda s: (cost(s) / min(s, smaller), s)), 0])
            k = len(bins) - 1
        out.append((length, k, bins[k][1]))
        bins[k][1] += length
    return out, [min(s for s in permitted if s >= content) for _, content in bins]


def test_plan_equals_item_by_item():
    draw = random.Random(5)
    for _ in range(100):
        sizes = tuple(sorted(draw.sample([8, 16, 20, 32, 40, 64], 3)))
        items = [draw.randint(1, draw.choice([6, sizes[-1]])) for _ in range(draw.randint(1, 150))]
        cost = packing.Cost(draw.choice([0, 3, 10]), draw.choice([0, 0.01, 0.1]))
        plan = packing.best_fit(dict(Counter(items)), sizes, sizes, cost)
        slots, sizes_of = slow_pack(items, sizes, sizes, cost)
        mine, left = [], Counter(items)
        ordered = sorted(plan.slots, key=lambda s: (-s[0], s[1]))
        for (length, start, first, each, content), after in zip(ordered, [*ordered[1:], (0,) * 5], strict=True):
            end = after[1] if after[0] == length else left[length]
            mine += [(length, first + (i - start) // each, content + (i - start) % each * length) for i in range(start, end)]
        assert mine == slots
        assert [size for first, size in sorted((b.first + k, b.size) for b in plan.bins for k in range(b.n))] == sizes_of


def check_packed(rows, tokens, sizes):
    """Every piece once, no overlap in a bin, every bin the smallest size for its contents."""
    pieces = sorted((r.doc_id is None, r.doc_id, r.start_token, r.n_tokens) for r in rows)
    largest = max(sizes)
    expected = [(i is None, i, a, min(largest, n - a)) for i, n in tokens for a in range(0, max(n, 1), largest)]
    assert pieces == sorted(expected)
    bins = {}
    for r in rows:
        assert (r.bin_id is None) == (r.n_tokens == 0)
        if r.n_tokens:
            bins.setdefault((r.bin_id, r.bin_size), []).append((r.bin_offset, r.n_tokens))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), parts in bins.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert size == min(s for s in sizes if s >= end)


@pytest.mark.parametrize("part_rows", [50_000, 3])
def test_packing(spark, small, odd, none, monkeypatch, part_rows):
    monkeypatch.setattr(packing, "PART_ROWS", part_rows)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for frame, sizes in ((docs, packing.SIZES), (odd, (8, 32, 64))):
        tokens = [(r.doc_id, len((r.text or "").split())) for r in frame.select("doc_id", "text").collect()]
        check_packed(packing.pack(frame, sizes).collect(), [(i, n) for i, n in tokens], sizes)
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("bucket_docs", [1024, 4])
def test_mixing_equals_sql(spark, medium, monkeypatch, bucket_docs):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", bucket_docs)
    assert_same(queries.op10_mixing(spark, medium).toPandas(), connect(medium).execute(queries.oracle_sql()["op10_mixing"]).df())


@pytest.mark.parametrize("most", [10_000, 1])
def test_mixing_of_any_sources(spark, medium, tmp_path, monkeypatch, most):
    """Sources without a number are domains of their own; the lists of leaves may be broadcast or not."""
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", most)
    source = "case when doc_id % 5 = 0 then concat('host', doc_id % 3, '.org') when doc_id % 7 = 0 then null else source end"
    docs = spark.read.parquet(f"{medium}/documents.parquet").withColumn("source", F.expr(source))
    docs.coalesce(1).toPandas().to_parquet(f"{tmp_path}/documents.parquet", index=False)
    found = queries.op10_mixing(spark, str(tmp_path)).toPandas()
    assert {"host0.org", "(none)"} <= set(found.domain)
    assert_same(found, connect(str(tmp_path)).execute(queries.oracle_sql()["op10_mixing"]).df())


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 1, 10), ("a", "y", 1, 1000), ("b", "x", 1, 20), ("c", "x", 1, 1000), ("d", "x", 1, 500)],
        "domain string, lang string, n_docs long, tokens long",
    )
    weights = {"domain": {"d": 0, "c": 2}}
    rows = mixing.leaf_budgets(leaves, weights, 1, 400, ("domain", "lang")).collect()
    # b can give only 20 of its 100, so a and c share 380 as 1 to 2; of a's 126, x can give only 10.
    assert {(r.domain, r.lang): r.target for r in rows} == {
        ("a", "x"): 10, ("a", "y"): 116, ("b", "x"): 20, ("c", "x"): 253, ("d", "x"): 0,
    }


def test_mixing_of_odd_rows(spark, odd, none):
    rows = mixing.mix(odd, {}, max_epochs=2).collect()
    assert set(odd.columns) | {"_mixed"} == set(rows[0].asDict())
    words = {r["_mixed"]["n_tokens"] for r in rows if r.doc_id in (3, 4, 5)}
    assert words <= {0} and max(r["_mixed"]["epoch"] for r in rows) <= 1
    assert mixing.mix(none, {}).count() == 0


def test_stages(spark, odd, small):
    docs, counts = spark.read.parquet(f"{small}/documents.parquet"), {}
    for frame in (docs, odd):
        rows = frame
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, small).cache()
            counts[name] = rows.count()
            if name != "packing":
                assert rows.columns == frame.columns
            if name == "secrets":
                texts = [r.text for r in rows.collect()]
                assert not any(secrets.base_spans(t or "") for t in texts)
                assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows.collect())
    assert counts["language"] == sum(any(c.isalpha() for c in t or "") for _, t in TEXTS)


def test_the_model_decides_what_the_language_stage_keeps(spark, medium):
    """What goes and what ``lang`` becomes is what the network says, document by document; other languages go on request."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    texts = [r.text for r in docs.where("lang = 'en'").orderBy("doc_id").limit(3).collect()]
    others = [r.text for r in docs.where("lang = 'de'").orderBy("doc_id").limit(3).collect()]
    mixed = " ".join(w for pair in zip(" ".join(texts).split(), " ".join(others).split(), strict=False) for w in pair)
    extra = [(-1, "ZZQQ!! XX!! VV!! KK!! " * 40, "en"), (-2, texts[0], "fr"), (-3, mixed, "en"), (-4, "123", "en"), (-5, None, "en")]
    more = docs.unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string").selectExpr("*", "'s' as source", "0L as n_chars")
    )
    model = language.train_language_model(more)
    rows = more.select("doc_id", "text").collect()
    shares = model.documents([r.text for r in rows])
    letters = [any(c.isalpha() for c in r.text or "") for r in rows]
    best = {
        r.doc_id: model.languages[int(s.argmax())] for r, s, known in zip(rows, shares, letters, strict=True)
        if known and s.max() >= corpus_pipeline.LEAST_SCORE
    }
    kept = language.keep_known(more, model, corpus_pipeline.LEAST_SCORE).select("doc_id", "lang").collect()
    assert {r.doc_id: r.lang for r in kept} == best and len(kept) == len(best)
    assert best[-2] == "en" and -4 not in best and -5 not in best
    sure = language.keep_known(more, model, 0.9)
    assert {r.doc_id for r in sure.collect()} == {
        r.doc_id for r, s, known in zip(rows, shares, letters, strict=True) if known and s.max() >= 0.9
    }
    assert sure.count() < len(best)
    english = language.keep_known(more, model, corpus_pipeline.LEAST_SCORE, ["en"])
    assert {r.doc_id for r in english.collect()} == {i for i, lang in best.items() if lang == "en"}
    plan = sure._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_without_labels_no_language_can_be_told(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, docs, medium).count() == 0


def test_clean_documents_stay(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    told = corpus_pipeline.known_language(spark, docs, medium).toPandas()
    before = docs.toPandas()
    assert len(told) >= 0.995 * len(before)
    both = told.merge(before, on="doc_id", suffixes=("", "_before"))
    assert len(both) == len(told) and (both.text == both.text_before).all()
    assert 0.98 < (both.lang == both.lang_before).mean()
    kept = corpus_pipeline.one_per_group(spark, docs, medium)
    assert kept.count() == simhash.near_duplicates(docs).select("component_id").distinct().count()
    untouched = corpus_pipeline.without_secrets(spark, docs, medium).join(docs, ["doc_id", "text"]).count()
    assert untouched >= docs.count() - docs.where(F.col("text").rlike(r"token|password|AKIA|[0-9a-f]{32}")).count() - 5


def test_pipeline_and_empty_tables(spark, small, none):
    assert corpus_pipeline.run(spark, small).count() > 100
    rows = none
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, small)
    assert rows.count() == 0
