"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def usable(rows: DataFrame, item: str, vector: str) -> DataFrame:
    """(item long, vector): the rows with a vector that has only finite components, one of them not 0, and an item.

    Negative zeros become zeros, so equal vectors are equal bit by bit. Vectors must have one length; of several
    lengths the most frequent one stays (of equally frequent ones the longest).
    """
    x = F.col("vector")
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    kind = "array<float>" if dict(rows.dtypes)[vector] == "array<float>" else "array<double>"
    own = rows.select(F.col(item).cast("long").alias("item"), F.col(vector).alias("vector"))
    own = own.where(F.col("item").isNotNull() & ok).withColumn("vector", F.transform(x, lambda v: v + F.lit(0.0)).cast(kind))
    own = written(own, "vectors")
    sizes = own.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return own.where(F.size("vector") == sizes[0]["n"]) if sizes else own


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def units(x: np.ndarray) -> np.ndarray:
    """The rows, scaled to length 1; scaled by their largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
