"""From documents to packed training sequences: five stages, each written and read again.

Every stage takes all rows that the one before it kept. Null and empty texts, repeated rows, empty
tables and further columns are handled as the operators say; further columns stay up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import language, mixing, packing, queries, secrets, simhash
from ledgerwatch.llm.common import shared_folder, small_batches, table, unused
from ledgerwatch.sources.folders import remove


#: Documents whose language is told with a smaller score go: languages mixed with others, and hardly any words.
LEAST_SCORE = 0.5
#: The languages to keep; None keeps all that documents are labelled with.
LANGUAGES: list[str] | None = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told, which is their ``lang`` from here on: the mixing reads it.

    The network learns from the labelled documents of the table and predicts all. What it rejects goes: texts that are
    null or without letters, and those with a mean probability below ``LEAST_SCORE``. If no document is labelled there is
    nothing to learn from, no language can be told, and all documents go.
    """
    return language.keep_known(docs, language.train_language_model(docs), LEAST_SCORE, LANGUAGES)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: three-word shingles, two bits."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` follows the text."""
    field = secrets.train_field(docs)
    text = unused(docs, "redacted")
    masked = small_batches(docs).withColumn(text, secrets.redacted(F.col("text"), field))
    columns = {"text": f"`{text}`", "n_chars": f"cast(char_length(`{text}`) as bigint)"}
    return masked.selectExpr(*[f"{columns.get(c, f'`{c}`')} as `{c}`" for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, divided by weight; a document has one row for each epoch that reads it."""
    drawn = mixing.mix(docs, queries.WEIGHTS, queries.MAX_EPOCHS, seed=queries.SEED)
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("simhash", one_per_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

# No stage but the mixing can be expressed in SQL: tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``. What a stage has written is removed when the next one is done."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
