"""One registered query per operator, each over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import (
    divergence,
    html,
    language,
    licenses,
    manifest,
    mixing,
    neighbours,
    oracle,
    packing,
    quality,
    secrets,
    simhash,
    tokens,
    topk,
)
from ledgerwatch.llm.common import table

#: Weights of the mixture; values that are not named weigh one.
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2},
    "lang": {"en": 5, "de": 2, "fr": 2},
}
MAX_EPOCHS = 2
SEED = 42


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, WEIGHTS, MAX_EPOCHS, seed=SEED).select("doc_id", "mixed.*")


#: One more character, where there is a number: what tampering does to a row.
ROW = ["doc_id", "source", "lang", "n_chars", "text"]
ALTERED = ["doc_id", "source", "lang", "cast(n_chars as decimal(20,0)) + 1", "text"]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    altered = f"if(crc32(cast(doc_id as string)) % 7 = 0 and n_chars is not null, {manifest.leaf_digest(ALTERED)}, null)"
    made = manifest.manifest(docs, "lang", "doc_id", manifest.leaf_digest(ROW), keep=(f"{altered} as altered",))
    shown = ["item as doc_id", "digest as leaf", "subroot", "root", f"{manifest.proof_digest()} as proof_sha256"]
    found = manifest.proofs(made).selectExpr(*shown, f"{manifest.folded('coalesce(altered, digest)')} as folded_root")
    return found.selectExpr("*", "folded_root = root as verified")


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # where the vocabulary files of this machine are; the operator takes any path

    return tokens.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op10_mixing": _mixing_sql(), "op11_merkle": oracle.merkle_sql(), "op13_divergence": oracle.divergence_sql()}


def _mixing_sql() -> str:
    steps = [
        r"""docs AS (SELECT doc_id,
            CASE WHEN regexp_matches(source, '^src[0-9]{1,9}$')
                THEN 'domain' || (CAST(substr(source, 4) AS INTEGER) // 5) ELSE coalesce(source, '(none)') END AS domain,
            coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
            CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
        FROM documents)""",
        """leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens
        FROM docs GROUP BY ALL)""",
        "share0 AS (SELECT sum(tokens) AS granted FROM leaves)",
    ]
    path: list[str] = []
    for depth, level in enumerate(mixing.LEVELS, 1):
        parent, path = ", ".join(path), [*path, level]
        cases = " ".join(f"WHEN '{v}' THEN {w}" for v, w in WEIGHTS.get(level, {}).items())
        weight = f"CASE {level} {cases} ELSE 1 END" if cases else "1"
        join = f"JOIN share{depth - 1} USING ({parent})" if parent else ", share0"
        family = f"PARTITION BY {parent}" if parent else ""
        order = f"{family} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {level}"
        steps.append(
            f"""share{depth} AS (
            WITH children AS (
                SELECT {", ".join(path)}, sum(tokens) * {MAX_EPOCHS} AS capacity, CAST({weight} AS HUGEINT) AS weight
                FROM leaves GROUP BY ALL),
            tested AS (SELECT *,
                granted - coalesce(sum(capacity) OVER
                    ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
                sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS competing
                FROM children {join}),
            sorted AS (SELECT *, capacity * competing <= left_over * weight AS is_full FROM tested)
            SELECT {", ".join(path)}, CASE WHEN is_full THEN capacity ELSE greatest(0,
                max(left_over) FILTER (NOT is_full) OVER ({family}) * weight
                // max(competing) FILTER (NOT is_full) OVER ({family})) END AS granted
            FROM sorted)"""
        )
    return f"""WITH {", ".join(steps)},
        plan AS (SELECT domain, lang, source, CAST(granted // tokens AS BIGINT) AS whole, granted % tokens AS rest
            FROM leaves JOIN share3 USING (domain, lang, source) WHERE granted > 0 AND tokens > 0),
        placed AS (SELECT *, md5({SEED} || ':' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
            FROM docs JOIN plan USING (domain, lang, source)),
        read AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) < rest AS again
            FROM placed)
        SELECT doc_id, domain, lang, source, n_tokens,
            CAST(unnest(range(whole + CASE WHEN again THEN 1 ELSE 0 END)) AS INTEGER) AS epoch
        FROM read"""
