"""Percentiles of a column, exact at any number of distinct values, or approximate.

Exact (``percentiles``): order statistics are found by refining histograms. The values of
a group are counted in ``CELLS`` equal cells between its least and greatest value; a wanted
rank falls into one cell, whose rows alone go on to the next round, between that cell's own
extremes, until a cell holds a single value. A task's state is one counter per cell and
wanted interval, combined map-side; what comes to the driver is a row per wanted rank. The
number of rounds grows with the logarithm of the values' spread, not with their count.

Approximate (``approx_percentiles``): one pass with a mergeable quantile sketch.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shrinkfx.session import materialize

CELLS = 4096


def _interpolated(n: int, p: float, at: dict[int, float]) -> float:
    """R type 7 between the order statistics ``at`` (0-based rank -> value)."""
    place = p * (n - 1)
    low, high = math.floor(place), math.ceil(place)
    if low == high or at[low] == at[high]:
        return at[low]
    return (high - place) * at[low] + (place - low) * at[high]


def order_statistics(df: DataFrame, col: str, ranks, by: str | None = None) -> tuple[dict, dict]:
    """({group: count}, {group: {rank: value}}) for 0-based ranks of the values of ``col``
    that are numbers (null and NaN are left out). ``ranks`` maps a count to the ranks that
    are wanted. Groups and ranks should be few: they come to the driver."""
    x = F.col(col).cast("double")
    rows = df.select((F.col(by) if by else F.lit(0)).alias("g"), x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    about = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    counts, found = {r.g: r.n for r in about}, {r.g: {} for r in about}
    # an interval: (id, group, lo, hi, rows below it, wanted ranks)
    open_, number = [], 0
    for r in about:
        wanted = sorted(set(ranks(r.n)))
        if r.lo == r.hi:
            found[r.g] = dict.fromkeys(wanted, r.lo)
        elif wanted:
            open_.append((number, r.g, r.lo, r.hi, 0, wanted))
            number += 1
    spark, first = df.sparkSession, True
    while open_:
        spans = F.broadcast(spark.createDataFrame(
            [(t, g, lo, (hi / CELLS - lo / CELLS), hi) for t, g, lo, hi, _, _ in open_],
            rows.select(F.lit(0).alias("t"), "g", F.col("x").alias("lo"), F.col("x").alias("width"), F.col("x").alias("hi")).schema))
        met = rows.join(spans, rows["g"].eqNullSafe(spans["g"])).drop(spans["g"]) if first else rows.join(spans.drop("g"), "t")
        # a width that underflows leaves two cells: the least value and the rest
        place = F.when(F.col("width") > 0, F.floor((F.col("x") - F.col("lo")) / F.col("width"))).otherwise(
            F.when(F.col("x") > F.col("lo"), 1).otherwise(0))
        # the greatest value has a cell of its own, so every round parts an interval
        cell = F.when(F.col("x") >= F.col("hi"), CELLS).otherwise(F.least(F.lit(CELLS - 1), place)).cast("int")
        celled = met.select("t", "g", "x", cell.alias("cell"))
        hist = celled.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = hist.withColumn("upto", F.sum("c").over(Window.partitionBy("t").orderBy("cell")))
        wanted = spark.createDataFrame([(t, k - base, k) for t, _, _, _, base, ks in open_ for k in ks],
                                       "t int, place long, rank long")
        hit = upto.join(F.broadcast(wanted), "t").where(
            (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("c")))
        cells: dict[tuple, list] = {}
        for r in hit.select("t", "cell", "lo", "hi", (F.col("upto") - F.col("c")).alias("below"), "rank").collect():
            cells.setdefault((r.t, r.cell, r.lo, r.hi, r.below), []).append(r["rank"])
        group, base = {t: g for t, g, *_ in open_}, {t: b for t, _, _, _, b, _ in open_}
        open_, going = [], []
        for (t, c, lo, hi, below), ks in sorted(cells.items()):
            if lo == hi:
                found[group[t]].update(dict.fromkeys(ks, lo))
            else:
                open_.append((number, group[t], lo, hi, base[t] + below, ks))
                going.append((t, c, number))
                number += 1
        if open_:
            on = F.broadcast(spark.createDataFrame(going, "t int, cell int, next int"))
            rows = materialize(celled.join(on, ["t", "cell"]).select(F.col("next").alias("t"), "g", "x"), "percentile_rows")
            first = False
    return counts, found


def percentiles(df: DataFrame, col: str, probs: Sequence[float], by: str | None = None) -> DataFrame:
    """``([by,] prob, value)``: exact, with linear interpolation between order statistics
    (R type 7). ``df`` is read about three times: pass a stored table. A column (or group)
    without numbers has no rows."""
    probs = [float(p) for p in probs]

    def ranks(n: int) -> list[int]:
        return [r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    counts, found = order_statistics(df, col, ranks, by)
    rows = [((g,) if by else ()) + (p, float(_interpolated(n, p, found[g]))) for g, n in counts.items() for p in probs]
    kind = f"`{by}` {df.schema[by].dataType.simpleString()}, " if by else ""
    return df.sparkSession.createDataFrame(rows, f"{kind}prob double, value double")


def approx_percentiles(df: DataFrame, col: str, probs: Sequence[float], by: str | None = None,
                       accuracy: int = 10_000) -> DataFrame:
    """``([by,] prob, value)`` from one pass with a mergeable sketch: a value of the column
    whose rank is off by at most ``count / accuracy``; no interpolation."""
    probs = [float(p) for p in probs]
    sketch = F.percentile_approx(F.col(col), probs, accuracy).alias("q")
    rows = df.groupBy(by).agg(sketch) if by else df.agg(sketch)
    listed = F.expr("array(" + ", ".join(f"{p!r}D" for p in probs) + ")")
    return rows.select(*([by] if by else []), F.posexplode("q").alias("i", "value")).select(
        *([by] if by else []), F.element_at(listed, F.col("i") + 1).alias("prob"), F.col("value").cast("double").alias("value"))
