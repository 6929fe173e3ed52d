import pytest
from pyspark.sql import functions as F

LONG = "The long text has very many words. " * 4000
TEXTS = [
    (1, "And the thing is that they were there before the others came along."),
    (1, "And the thing is that they were there before the others came along."),
    (2, "And the thing is that they were there before the others came along."),
    (3, ""),
    (4, None),
    (5, "   \n\t "),
    (6, "!!! ... 123"),
    (7, LONG),
    (None, "A row without id, but with some words of its own in it."),
    (None, None),
    (8, "один два три 四五 ß é \U0001f600 words"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents of every odd kind, with further columns whose names operators use themselves."""
    rows = [(i, t, None if k % 4 == 3 else "en", f"src{k % 3}" if k % 5 else None, k) for k, (i, t) in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("score", "fingerprint", "component_id", "found", "place", "kind", "mixed", "n_tokens_", "bin_id", "spans"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs.repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
