"""The manifest, the tokenizer and the divergence audit."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerwatch.llm import divergence, manifest, oracle, queries, tokens
from tests.compare import assert_same, connect

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_table(folder, frame):
    """The frame as the table ``documents`` of a new folder."""
    frame.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# Manifest


def slow_levels(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + fanout])) for i in range(0, len(low), fanout)])
    return levels


def slow_path(levels, k, fanout):
    path = []
    for level in levels[:-1]:
        first = k // fanout * fanout
        path.append(("".join(level[first:k]), "".join(level[k + 1 : first + fanout])))
        k //= fanout
    return path


def slow_manifest(rows, fanout=2):
    """``(doc_id, leaf, subroot, root, proof, folded root)`` of each row."""

    def leaf(doc_id, text, lang, source, n_chars):
        parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
        return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in parts))

    def altered(row):
        changed = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
        return leaf(*row[:4], row[4] + 1) if changed else leaf(*row)

    trees = {}
    for lang in sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode())):
        of_lang = [r for r in rows if r[2] == lang]
        trees[lang] = sorted(of_lang, key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    below = {lang: slow_levels([leaf(*r) for r in of_lang], fanout) for lang, of_lang in trees.items()}
    above = slow_levels([levels[-1][0] for levels in below.values()], fanout)
    out = []
    for place, (lang, of_lang) in enumerate(trees.items()):
        for k, row in enumerate(of_lang):
            path = slow_path(below[lang], k, fanout) + slow_path(above, place, fanout)
            folded = altered(row)
            for left, right in path:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((row[0], leaf(*row), below[lang][-1][0], above[-1][0], proof, folded))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def found_manifest(spark, folder):
    rows = queries.op11_merkle(spark, folder).collect()
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in rows)
    return sorted((tuple(r)[:6] for r in rows), key=key)


def test_manifest_odd(spark, odd, tmp_path):
    names = [f.split()[0] for f in DOCS.split(", ")]
    found = found_manifest(spark, as_table(tmp_path, odd))
    assert found == sorted(slow_manifest([tuple(r) for r in odd.select(*names).collect()]), key=key)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 33, 1100])
def test_manifest_sizes(spark, tmp_path, n):
    rows = [(i % 700 if i % 11 else None, f"text {i % 13}", ["en", "de", None, ""][min(3, i % 9)], "s", 2**63 - 1) for i in range(n)]
    found = found_manifest(spark, as_table(tmp_path, spark.createDataFrame(rows, DOCS).repartition(5)))
    assert found == sorted(slow_manifest(rows), key=key)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_requests(spark, fanout):
    rows = [(i, f"t{i}", ["a", "b", "c", "d", "e", "f"][i % 7 % 6], "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    made = manifest.manifest(docs, "lang", "doc_id", manifest.leaf_digest(queries.ROW), fanout)
    asked = made.leaves.nodes.where("item % 50 = 3")
    found = manifest.proofs(made, asked).selectExpr("*", f"{manifest.folded('digest')} as folded_root").collect()
    expected = {r[0]: r for r in slow_manifest(rows, fanout)}
    assert sorted(r["item"] for r in found) == list(range(3, 400, 50))
    for r in found:
        proof = sha("".join(p["left"] + p["right"] for p in r["path"]))
        assert (r["digest"], r["subroot"], r["root"], proof) == expected[r["item"]][1:5]
        assert r["reached"] == r["digest"] and r["folded_root"] == r["root"]


def test_manifest_records(spark):
    # Equal rows give equal subtrees: the store keeps one of them.
    docs = spark.createDataFrame([(1, "same", "en", "s", 4)] * 256, DOCS)
    made = manifest.manifest(docs, "lang", "doc_id", manifest.leaf_digest(queries.ROW))
    records = made.records().collect()
    assert len(records) == 8
    assert all(r["digest"] == sha("".join(r["children"])) for r in records)
    assert manifest.proofs(made).selectExpr(f"{manifest.folded('digest')} = root as ok").where("ok").count() == 256


def test_merkle_sql(spark, small, tmp_path):
    assert_same(queries.op11_merkle(spark, small).toPandas(), connect(small).execute(oracle.merkle_sql()).df())


# Tokens


@pytest.fixture(scope="module")
def encoder():
    return tokens.encoder(tokens.file_content(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TRICKY = [
    "", " ", "a" * 3000, " " * 3000, "ab" * 999, "x <|endoftext|> y<|endoftext|><|endoftext|>", "<|endoftext|", "it's we'LL I'd",
    "\n\n \t x  \n", "\x00\x01\x7f", "é 五 ß \U0001f600\U0001f600", "12345 67,8", "oooeaoaoo", "    　x", "A\r\nB",
]


def test_tokens_tricky(encoder, library):
    for text in TRICKY:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert encoder.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("aeionrst' 19\n", max_size=80)))
def test_tokens_any_text(encoder, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_tokens_joined(encoder, library):
    """Texts of whole tokens put together at random: many of them must not stay as they are."""
    draw, vocabulary = random.Random(5), tokens.Vocabulary.read(tokens.file_content(PATH))
    texts = [t.decode("utf-8", "ignore") for t in vocabulary.tokens.values()]
    for _ in range(2000):
        text = "".join(draw.choices(texts, k=draw.randint(1, 7)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids


def test_pairs_by_merging(encoder, library):
    """The table of compatible pairs says what merging the two tokens' bytes gives."""
    draw = random.Random(6)
    plain = [i for i in encoder.length if encoder.decode_bytes(np.array([i])).isalpha()]
    for _ in range(3000):
        pair = draw.choices(plain, k=2)
        merged = library.model.tokenize("".join(library.id_to_token(i) for i in pair))
        assert encoder.fits(*pair) == ([t.id for t in merged] == pair)


def test_small_vocabulary():
    """A token that its own bytes do not give is never used; nor is one that is made too late."""
    ids = {b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"ab": 4, b"abc": 5}
    vocabulary = tokens.Vocabulary({i: t for t, i in ids.items()}, [(1, 2, 3), (0, 1, 4), (4, 2, 5)], {})
    encoder = tokens.Encoder(vocabulary)
    assert encoder.encode("abc") == [0, 3]
    assert encoder.encode("ab") == [4]
    assert encoder.encode("abcab") == [0, 3, 4]


def test_parts_do_not_matter(encoder, monkeypatch):
    text = "Some words, and <|endoftext|> others: " * 50 + "z" * 200
    expected, digests = encoder.encode(text), encoder.digests(text)
    monkeypatch.setattr(tokens, "PART_PIECES", 3)
    monkeypatch.setattr(tokens, "PART_CHARS", 10)
    monkeypatch.setattr(tokens, "KEPT_PIECES", 5)
    assert encoder.encode(text) == expected and encoder.digests(text) == digests


def test_decode_invalid(encoder, library):
    draw = random.Random(7)
    for _ in range(300):
        ids = draw.choices(range(50257), k=draw.randint(0, 6))
        assert encoder.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)


def test_op12(spark, small, odd, none, library, tmp_path):
    def expected(frame):
        rows = []
        for doc_id, text in frame.select("doc_id", "text").collect():
            ids = library.encode(text or "", add_special_tokens=False).ids
            rows.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
        return sorted(rows, key=key)

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted((tuple(r) for r in queries.op12_tokens(spark, small).collect()), key=key) == expected(docs)
    assert sorted((tuple(r) for r in tokens.token_digests(odd, PATH).collect()), key=key) == expected(odd)
    assert tokens.token_digests(none, PATH).count() == 0


def test_encoded_and_decoded(spark, odd, library):
    ids = odd.select("text", tokens.encoded(F.col("text"), PATH).alias("ids"))
    rows = ids.select("text", "ids", tokens.decoded(F.col("ids"), PATH).alias("again")).collect()
    for r in rows:
        assert list(r["ids"]) == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["again"] == (r["text"] or "")


# Divergence


def slow_audit(rows, min_docs, top):
    """The audit of ``(lang, source, text)`` in whole numbers, term by term."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(lang or "", source or "", (text or "").translate(lower)) for lang, source, text in rows]
    found = [(a, b, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)) for a, b, t in texts]
    out = []
    for lang in {a for a, _, _ in found}:
        docs, counts = Counter(), {}
        for a, b, terms in found:
            if a == lang:
                docs.update(set(terms))
                counts.setdefault(b, Counter()).update(terms)
        kept = [t for t, n in docs.items() if n >= min_docs]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {source: shares(count) for source, count in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for source, own in p.items():
            pairs = [(o, sum((own[t] - x[t]) ** 2 // (own[t] + x[t]) for t in kept)) for o, x in p.items() if o != source]
            more = [t for t in kept if counts[source][t] and own[t] > q[t]]
            terms = [(t, (own[t] - q[t]) ** 2 // (own[t] + q[t])) for t in more]
            for part, items, last in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:last]
                out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def audited(frame, **settings):
    return sorted(tuple(r) for r in divergence.audit(frame, **settings).collect())


def read(frame):
    return [tuple(r) for r in frame.select("lang", "source", "text").collect()]


@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_audit_odd(odd, none, min_docs):
    assert audited(odd, min_docs=min_docs) == slow_audit(read(odd), min_docs, 10)
    assert audited(none) == []


def made_up(spark, draw, n, n_sources):
    letters = ["a", "bb", "Ab", "zwölf", "acht", "abcdefgh", "abcdefghi", "sechzehnbuchstab", "siebzehnbuchstabe", "ü" * 40, "五", "x" * 300]
    rows = []
    for k in range(n):
        words = draw.choices(letters, k=draw.randint(0, 30))
        rows.append((k, draw.choice([" ", ", ", "\x00", "9"]).join(words), draw.choice(["en", "de", None]), f"s{draw.randrange(n_sources)}", 1))
    rows += [(n, "lonely words only", "it", f"s{i}", 1) for i in range(3)] + [(n, "", "nothing", None, 1)]
    return spark.createDataFrame(rows, DOCS)


def test_audit_made_up(spark):
    docs = made_up(spark, random.Random(3), 150, 9)
    assert audited(docs, min_docs=3, top=4) == slow_audit(read(docs), 3, 4)


def test_audit_tiles_and_blocks(spark, monkeypatch):
    """Many tiles of sources, small blocks of text, cut texts and joins without broadcast lists."""
    docs = made_up(spark, random.Random(4), 120, 11)
    expected = slow_audit(read(docs), 2, 10)
    monkeypatch.setattr(divergence, "TILE", 3)
    for name in ("MOST_GROUPS", "MOST_TILES"):
        monkeypatch.setattr(divergence, name, 0)
    assert audited(docs, min_docs=2) == expected
    texts = [t or "" for _, _, t in read(docs)]
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 50)
    for text in texts:
        terms, n = divergence.long_text_counts(text.encode())
        low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        slow = Counter(t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        assert dict(zip(terms, n.tolist(), strict=True)) == dict(slow)


def test_radix_order():
    draw = np.random.default_rng(1)
    words = [draw.integers(0, 4, 5000).astype(np.uint64) << np.uint64(s) for s in (60, 17)]
    assert (divergence.radix_order(words) == np.lexsort(words[::-1])).all()


def test_counts_beyond_a_long(spark):
    """A term that occurs 10^10 times: its share is still exact."""
    row = spark.sql(f"select {divergence.figure('n', 'total', 'kept')} as p from values (10000000000L, 90000000000L, 7L) as t(n, total, kept)")
    assert row.first()[0] == 1 + 10**9 * (10**10 + 2) // (9 * 10**10 + 14)


def test_divergence_sql(spark, small):
    assert_same(queries.op13_divergence(spark, small).toPandas(), connect(small).execute(oracle.divergence_sql()).df())
