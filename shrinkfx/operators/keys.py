"""Keyed joins with R-style NULL matching (NULL key == NULL key), stacking, recoding.

Every key comparison is ``<=>`` (``eqNullSafe``): it still plans as an
equi-join (hash / sort-merge / broadcast), and a NULL key such as a missing
release year matches the NULL group of the other side, as dplyr joins do.
Join strategy is left to Catalyst + AQE: a side is broadcast only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_R = "__r_"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _renamed(other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return other.withColumnsRenamed({k: _R + k for k in keys})


def _cond(df: DataFrame, other_r: DataFrame, keys: Sequence[str]):
    return reduce(lambda a, b: a & b,
                  [df[k].eqNullSafe(other_r[_R + k]) for k in keys])


def attach(df: DataFrame, table: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join ``table``'s non-key columns onto ``df`` by ``keys`` (null-safe)."""
    keys = _keys(keys)
    t = _renamed(table, keys)
    out = df.join(t, _cond(df, t, keys), how)
    return out.drop(*[_R + k for k in keys])


def keep_known(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Semi join: rows of ``df`` whose key values occur in ``other``.

    ``other`` is reduced to its distinct keys first, so the side that is
    shuffled or broadcast is one row per key, aggregated map-side.
    """
    keys = _keys(keys)
    t = _renamed(other.select(*keys).distinct(), keys)
    return df.join(t, _cond(df, t, keys), "left_semi")


def drop_present(df: DataFrame, other: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Anti join: rows of ``df`` with no match in ``other``.

    ``keys=None`` compares all common columns, so every copy of a matching
    row is removed (not a multiset difference).
    """
    keys = [c for c in df.columns if c in other.columns] if keys is None else _keys(keys)
    t = _renamed(other.select(*keys), keys)
    return df.join(t, _cond(df, t, keys), "left_anti")


def stack(*dfs: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Append rows by column name; columns missing in a part become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def recode(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Replace values of ``column`` by ``mapping`` (unmapped values kept)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(column, F.coalesce(m[F.col(column)], F.col(column)))


def key_text(key: str) -> Column:
    """A key as text that is never null, so that plain equality matches nulls too and keys
    of several kinds fit one column."""
    return F.coalesce(F.concat(F.lit("v"), F.col(key).cast("string")), F.lit("n"))


def from_key_text(text: str, kind: str) -> Column:
    return F.when(F.col(text) != "n", F.substring(F.col(text), 2, 1 << 30).cast(kind))


def key_registry(df: DataFrame, keys: Sequence[str], *carry: str) -> DataFrame:
    """``(carry..., kind, key)``: each row once per key, ``kind`` its place in ``keys`` and
    ``key`` its text. One scan serves all keys."""
    parts = [F.struct(F.lit(i).alias("kind"), key_text(k).alias("key")) for i, k in enumerate(keys)]
    return df.select(*carry, F.inline(F.array(*parts)))


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """``(keys..., n)`` of the keys that occur more than once (null keys are not reported)."""
    keys = _keys(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_by(df: DataFrame, keys) -> DataFrame:
    """``df`` as a lookup table: the plan raises an error when a key occurs twice, instead of
    letting a join multiply rows. Rows with a null key are left out."""
    keys = _keys(keys)
    rest = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    one = df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__row"))
    said = F.concat(F.lit(f"{', '.join(keys)} occurs twice or more: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return one.where(F.assert_true(F.col("__n") == 1, said).isNull()).select(*keys, "__row.*").select(*df.columns)
