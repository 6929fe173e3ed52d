"""What both vector operators need: which rows take part, and arrays of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Null when a vector is null; false when a component is null or not finite.
FINITE = "not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))"


def one_per_id(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", valid: str = FINITE) -> DataFrame:
    """``vec_id, vec`` with one row per id: of rows that share an id the smallest valid vector, or the
    smallest if none is valid. Rows without id are left out.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    smallest = F.expr(f"coalesce(min(if({valid}, vec, null)), min(vec))")
    return rows.where("vec_id is not null").groupBy("vec_id").agg(smallest.alias("vec"))


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows of ``dim`` components; shorter ones are filled with zeros."""
    out = np.zeros((len(vectors), dim))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def dimension(rows: DataFrame) -> int:
    return rows.agg(F.expr("coalesce(max(size(vec)), 0)")).first()[0]
