"""top_n with ties: ``n > 0`` keeps the largest weights, ``n < 0`` the smallest.

A row is kept when its weight is at least as extreme as the |n|-th value, so
ties at the cut are all kept and more than |n| rows can come back; rows with
NULL weight are never kept. The cut value is found with a bounded top-|n|
(``orderBy(...).limit(|n|)``, a per-partition heap of |n| rows) and used as a
scalar subquery, so no single task ever sorts the whole input. The input is
read twice (cut, then filter): pass a stored or cheap table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, weight: str) -> DataFrame:
    if n == 0:
        return df.limit(0)
    w = F.col(weight)
    valid = df.filter(w.isNotNull())
    k = abs(n)
    if n > 0:
        cut = valid.select(weight).orderBy(w.desc()).limit(k).agg(F.min(weight)).scalar()
        return valid.filter(w >= cut)
    cut = valid.select(weight).orderBy(w.asc()).limit(k).agg(F.max(weight)).scalar()
    return valid.filter(w <= cut)
