"""Vector columns: which rows take part, and how they become matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.Array, dims: int | None = None, dtype=np.float64) -> np.ndarray:
    """A list column as rows of a matrix; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if dims is None else dims
    rows = np.zeros((len(column), width), dtype=dtype)
    rows[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return rows


def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Each query's k highest scores, ties to the smaller vec_id, with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
