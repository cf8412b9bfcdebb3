"""Group statistics behind the exploration report.

Every operator is a partial (map-side) aggregate followed by a small final
step; none gathers a group into one task. Percentiles are exact (R type 7 /
linear interpolation) with bounded state, see ``quantiles``.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.operators.keys import attach
from shrinkfx.operators.quantiles import approx_percentiles, percentiles
from shrinkfx.session import materialize

__all__ = ["activity", "activity_sets", "approx_percentiles", "arg_extreme", "box_stats", "centred_mean",
           "distinct_counts", "distinct_sketches", "group_counts", "histogram", "kde", "mean_of_counts", "other_years",
           "percentiles", "shares", "year_ticks"]


def activity(df: DataFrame, key, feature: str | None = None, rating: str = "rating") -> DataFrame:
    """``(key, number_ratings, average_rating[, feature])``."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("number_ratings"),
                                F.avg(rating).alias("average_rating"))
    return out.withColumn("feature", F.lit(feature)) if feature else out


def activity_sets(df: DataFrame, features: Sequence[tuple[str, str]], rating: str = "rating") -> DataFrame:
    """``(<key columns>, feature, number_ratings, average_rating)``: ``activity`` of every
    (key, label) in one scan and one aggregate; the other keys of a row are NULL."""
    keys = [k for k, _ in features]
    sets = df.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys])
    out = sets.agg(F.count(F.lit(1)).alias("number_ratings"), F.avg(rating).alias("average_rating"),
                   F.grouping_id().alias("__set"))
    # the bit of the one key that was grouped by is 0, the first key's bit is the highest
    whole = (1 << len(keys)) - 1
    label = F.lit(None).cast("string")
    for i, (_, name) in enumerate(features):
        label = F.when(F.col("__set") == whole - (1 << (len(keys) - 1 - i)), F.lit(name)).otherwise(label)
    return out.withColumn("feature", label).drop("__set")


def centred_mean(df: DataFrame, key, mu, name: str = "average_rating",
                 rating: str = "rating") -> DataFrame:
    """``(key, name)`` = group mean of ``rating - mu``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(F.col(rating) - F.lit(mu)).alias(name))


def group_counts(df: DataFrame, key, name: str = "number_ratings") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_of_counts(df: DataFrame, key, name: str = "mean_number_ratings") -> DataFrame:
    """Mean number of rows per group (two-level aggregate)."""
    return group_counts(df, key, "c").agg(F.avg("c").alias(name),
                                          F.count(F.lit(1)).alias("n_groups"))


def shares(df: DataFrame, col: str, rules: Sequence[tuple]) -> DataFrame:
    """``(rule, share)``: fraction of rows meeting ``col <op> threshold`` for each (label, op, t)."""
    ops = {"<=": lambda c, t: c <= t, "<": lambda c, t: c < t,
           ">=": lambda c, t: c >= t, ">": lambda c, t: c > t}
    c = F.col(col)
    aggs = [F.avg(F.when(ops[op](c, F.lit(t)), 1.0).otherwise(0.0)).alias(f"s{i}")
            for i, (_, op, t) in enumerate(rules)]
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("rule"), F.col(f"s{i}").alias("share"))
        for i, (label, _, _) in enumerate(rules)])))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``(bin, x, xmin, xmax, n, density)``: equal-width bins over the range, the first
    and last centred on the minimum and maximum, right-closed; empty bins kept.

    ``df`` is read twice (range, then counts): pass a stored or cheap table."""
    x = F.col(col)
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("total")).first()
    lo, hi, total = st["lo"], st["hi"], st["total"]
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, x double, xmin double, xmax double, n bigint, density double")
    w = (hi - lo) / float(bins - 1) if hi > lo else 1.0
    L, W = F.lit(float(lo)), F.lit(float(w))
    b = F.greatest(F.lit(0), F.ceil((x - L) / W - F.lit(0.5)).cast("int"))
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = attach(grid, counts, "bin", "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return out.select(
        "bin",
        (L + F.col("bin") * W).alias("x"),
        (L + (F.col("bin") - F.lit(0.5)) * W).alias("xmin"),
        (L + (F.col("bin") + F.lit(0.5)) * W).alias("xmax"),
        n.alias("n"),
        (n / (F.lit(float(total)) * W)).alias("density"))


#: Kernels are summed as far as this many bandwidths from a value. What lies beyond changes
#: a density by less than ``exp(-KDE_REACH**2 / 2) / (h * sqrt(2 * pi))``, 1e-18 / h.
KDE_REACH = 9.0


def kde(df: DataFrame, col: str, points: int = 512) -> DataFrame:
    """``(i, x, density)``: Gaussian kernel density on ``points`` grid points over the range;
    bandwidth 0.9 * min(sd, IQR/1.34) * N^(-1/5) (Silverman's rule, interpolated quartiles).

    The sum is over the values themselves: equal values are counted first, and each distinct
    value meets the grid points within ``KDE_REACH`` bandwidths, a range of places computed
    from the value. Products are summed map-side, so one row per grid point and task is
    shuffled. Work is (distinct values) x (grid points in reach); the reach shrinks as N grows.
    """
    x = F.col(col).cast("double")
    counted = materialize(df.where(x.isNotNull() & ~F.isnan(x)).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c")), "kde_values")
    st = counted.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("c").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean")).first()
    if not st["n"]:
        return df.sparkSession.createDataFrame([], "i bigint, x double, density double")
    lo, hi, n = float(st["lo"]), float(st["hi"]), int(st["n"])
    gap = F.col("v") - F.lit(float(st["mean"]))
    squares = counted.agg(F.sum(gap * gap * F.col("c"))).first()[0]
    sd = math.sqrt(squares / (n - 1)) if n > 1 else 0.0
    at = {r["prob"]: r["value"] for r in percentiles(df, col, [0.25, 0.75]).collect()}
    spread = min(sd, (at[0.75] - at[0.25]) / 1.34)
    h = 0.9 * (spread if spread > 0 else (sd if sd > 0 else 1.0)) * float(n) ** -0.2
    step, reach = (hi - lo) / float(points - 1), KDE_REACH * h
    grid = df.sparkSession.range(points).select(F.col("id").alias("i"), (F.lit(lo) + F.col("id") * F.lit(step)).alias("x"))
    if step > 0:
        first = F.greatest(F.lit(0), F.ceil((F.col("v") - F.lit(lo + reach)) / F.lit(step))).cast("long")
        last = F.least(F.lit(points - 1), F.floor((F.col("v") - F.lit(lo - reach)) / F.lit(step))).cast("long")
    else:
        first, last = F.lit(0).cast("long"), F.lit(points - 1).cast("long")
    near = counted.select("v", "c", F.explode(F.when(first <= last, F.sequence(first, last))).alias("i"))
    z = (F.lit(lo) + F.col("i") * F.lit(step) - F.col("v")) / F.lit(h)
    sums = near.groupBy("i").agg(F.sum(F.col("c") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    norm = n * h * math.sqrt(2.0 * math.pi)
    return grid.join(F.broadcast(sums), "i", "left").select(  # a row per grid point at most
        "i", "x", (F.coalesce(F.col("s"), F.lit(0.0)) / F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, group: str, col: str, log10: bool = True) -> DataFrame:
    """Box-plot statistics of ``col`` (log10 first when ``log10``) per ``group``:
    quartiles, whiskers (extreme non-outlier values, never inside the box),
    outlier count (values beyond 1.5 IQR from the box)."""
    y = F.log10(F.col(col)) if log10 else F.col(col)
    d = df.select(group, y.alias("y"))
    at = percentiles(d, "y", [0.25, 0.5, 0.75], by=group)  # a few rows a group
    q = F.broadcast(at.groupBy(group).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                                            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]))
    q = q.withColumn("lo_fence", F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1")))
    j = attach(d, q.select(group, "lo_fence", "hi_fence"), group, "inner")
    inside = (F.col("y") >= F.col("lo_fence")) & (F.col("y") <= F.col("hi_fence"))
    w = j.groupBy(group).agg(
        F.min(F.when(F.col("y") >= F.col("lo_fence"), F.col("y"))).alias("lower_whisker"),
        F.max(F.when(F.col("y") <= F.col("hi_fence"), F.col("y"))).alias("upper_whisker"),
        F.count(F.lit(1)).alias("n"), F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outliers"))
    # whiskers never fall inside the box: range of (quartiles, non-outlier values)
    return attach(q.drop("lo_fence", "hi_fence"), w, group, "inner").select(
        group, "n", F.least("lower_whisker", "q1").alias("lower_whisker"), "q1", "median", "q3",
        F.greatest("upper_whisker", "q3").alias("upper_whisker"), "n_outliers")


def _plain_year(col: str):
    return F.when(F.col(col).rlike("^[0-9]{4}$"), F.col(col).cast("int"))


def year_ticks(df: DataFrame, col: str = "movie_year", step: int = 10) -> DataFrame:
    """``(tick)``: every ``step``-th year from the smallest to the largest four-digit year
    text. Empty texts and ranges are no years; ``other_years`` lists them."""
    r = df.agg(F.min(_plain_year(col)).alias("lo"), F.max(_plain_year(col)).alias("hi"))
    ticks = r.select(F.explode(F.sequence("lo", "hi", F.lit(step))).alias("t"))
    return ticks.select(F.col("t").cast("string").alias("tick"))


def other_years(df: DataFrame, col: str = "movie_year") -> DataFrame:
    """``(text, n)`` of the texts (or NULL) that are no plain year."""
    return group_counts(df.where(_plain_year(col).isNull()), col, "n").withColumnRenamed(col, "text")


def distinct_counts(df: DataFrame, columns: Sequence[str], *more, approx: bool = False, lg_k: int = 12) -> DataFrame:
    """One row with ``n_<column>`` distinct non-NULL values for all columns from one scan, and
    the aggregates ``more`` beside them. ``approx`` reads the counts from HyperLogLog sketches
    of ``2 ** lg_k`` registers instead (relative standard error about 1.04 / sqrt(2 ** lg_k),
    1.6 % by default), which shuffles one sketch per task and column."""
    if approx:
        s = distinct_sketches(df, columns, *more, lg_k=lg_k)
        rest = [c for c in s.columns if c not in {f"s_{k}" for k in columns}]
        return s.select(*[F.hll_sketch_estimate(f"s_{c}").alias(f"n_{c}") for c in columns], *rest)
    return df.agg(*[F.count_distinct(F.col(c)).alias(f"n_{c}") for c in columns], *more)


def distinct_sketches(df: DataFrame, columns: Sequence[str], *more, by: Sequence[str] = (), lg_k: int = 12) -> DataFrame:
    """``(by..., s_<column>)``: a mergeable HyperLogLog sketch of each column (as text), so that
    counts of new data join stored ones through ``hll_union_agg``."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"s_{c}") for c in columns]
    return (df.groupBy(*by) if by else df).agg(*sketches, *more)


def arg_extreme(df: DataFrame, by: str, ties: str, largest: bool = False) -> DataFrame:
    """The row with the smallest (or largest) ``by``; the smallest ``ties`` of equal ones."""
    order = F.struct(F.col(by), -F.col(ties)) if largest else F.struct(by, ties)
    pick = F.max_by if largest else F.min_by
    out = df.where(F.col(by).isNotNull()).agg(pick(F.struct(*df.columns), order).alias("r"))
    return out.select(*[F.col("r")[c].alias(c) for c in df.columns])
