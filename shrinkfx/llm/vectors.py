"""Embedding columns: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """True for a vector that is not null and holds finite numbers only."""
    x = F.lit(float("inf"))
    return vec.isNotNull() & F.forall(vec, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < x), F.lit(False)))


def usual_length(rows: DataFrame, vec_col: str) -> int:
    """The most frequent vector length (the longest of equally frequent ones); 0 without rows."""
    counts = rows.groupBy(F.size(vec_col).alias("n")).agg(F.count(F.lit(1)).alias("c"))
    top = counts.agg(F.max(F.struct("c", "n")).alias("t")).first()["t"]
    return top["n"] if top else 0


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all lists of one length, as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
