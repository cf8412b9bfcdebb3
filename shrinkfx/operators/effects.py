"""Regularised additive effects: fit, predict, score.

A model is a global mean ``mu`` plus a chain of keyed effects. Stage ``s``
estimates, per value of its key, ``b_s = sum(rating - mu - b_1 - ... - b_{s-1}) / (n + alpha)``
over the training rows, i.e. each effect is fitted on the residual of the
ones before. Prediction is ``mu + sum of the effects`` (no clipping).

Each effect table is one row per key value, written as a stage table: it is
reused by every later stage and by scoring, so it is computed once and its
lineage is cut. Joining rows to an effect table is left to AQE: small tables
(movies, genres, years, weeks) are broadcast after their size is measured, a
large one (users) is joined by shuffle, with skew-join splitting for hot keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.operators.keys import attach
from shrinkfx.session import stage


def effect(df: DataFrame, keys, residual, alpha: float) -> DataFrame:
    """``(keys..., n, effect)`` with ``effect = sum(residual) / (n + alpha)``; ``n`` counts the
    rows that have a residual, so a missing rating weighs nothing."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = F.col(residual) if isinstance(residual, str) else residual
    n = F.count(r)
    return df.groupBy(*keys).agg(n.alias("n"), (F.sum(r) / (n + F.lit(float(alpha)))).alias("effect"))


def mean_of(df: DataFrame, col: str = "rating") -> float:
    """A global mean, returned to the driver as one number."""
    return float(df.agg(F.avg(col)).first()[0])


def effect_col(key: str) -> str:
    return f"{key}_effect"


@dataclass
class EffectModel:
    mu: float
    alpha: float | None
    chain: list[str]
    tables: list[DataFrame] = field(default_factory=list)  # (key, n, effect) per stage
    paths: list[str] = field(default_factory=list)         # their folders, when written


def fit(train: DataFrame, chain: Sequence[str], alpha: float, mu: float | None = None,
        rating: str = "rating", keep: bool = True) -> EffectModel:
    """Fit the effect chain on ``train``; stage tables are written (``keep=True``).

    Rows are thin: the residual and the keys still to come. Once two effects are taken off,
    and two or more are still to come, they are written, so the join with a large second
    table (users) happens once per fit and later stages only join what came after.
    """
    mu = mean_of(train, rating) if mu is None else float(mu)
    model = EffectModel(mu=mu, alpha=alpha, chain=list(chain))
    rows = train.where(F.col(rating).isNotNull()).select((F.col(rating) - F.lit(mu)).alias("__res"), *dict.fromkeys(chain))
    for s, key in enumerate(chain):
        t = effect(rows, key, "__res", alpha)
        if keep:
            t, path = stage(t, f"effect_{key}")
            model.paths.append(path)
        model.tables.append(t)
        later = list(dict.fromkeys(chain[s + 1:]))
        if later:
            rows = attach(rows, t.select(key, F.col("effect").alias("__e")), key, "inner").select(
                (F.col("__res") - F.col("__e")).alias("__res"), *later)
            if keep and s == 1 and len(later) > 1:
                rows = stage(rows, "residuals")[0]
    return model


def predict(df: DataFrame, model: EffectModel, unseen: str = "zero",
            pred: str = "pred") -> DataFrame:
    """Add ``pred`` (and one ``<key>_effect`` column per stage).

    unseen="drop": inner joins, rows with an unknown key are removed;
    "zero": left joins, a missing effect counts as 0; "null": left joins,
    a missing effect makes ``pred`` NULL. ``n_unseen`` counts missing effects.
    """
    how = "inner" if unseen == "drop" else "left"
    out = df
    total = F.lit(model.mu)
    missing = F.lit(0)
    for key, t in zip(model.chain, model.tables):
        e = effect_col(key)
        out = attach(out, t.select(key, F.col("effect").alias(e)), key, how)
        total = total + (F.coalesce(F.col(e), F.lit(0.0)) if unseen == "zero" else F.col(e))
        missing = missing + F.when(F.col(e).isNull(), 1).otherwise(0)
    return out.withColumn(pred, total).withColumn("n_unseen", missing)


def rmse(df: DataFrame, pred: str = "pred", obs: str = "rating", by=None) -> DataFrame:
    """``(by..., n, n_null_pred, rmse)``; rows without an observation are left out, NULL
    predictions are counted, not scored."""
    df = df.where(F.col(obs).isNotNull())
    err = F.pow(F.col(pred) - F.col(obs), 2)
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col(pred).isNull(), 1).otherwise(0)).cast("bigint").alias("n_null_pred"),
            F.sqrt(F.avg(err)).alias("rmse")]
    if by:
        return df.groupBy(*([by] if isinstance(by, str) else by)).agg(*aggs)
    return df.agg(*aggs)
