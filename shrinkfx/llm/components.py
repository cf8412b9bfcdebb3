"""Connected components of a link table by alternating large-star and small-star steps.

Each step is one aggregate (least neighbour, combined map-side) and one join, written to
the shared folder, so a lost executor never costs more than a step. A hub is a long run
of one join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every linked id that is not its component's smallest one; an
    empty link table has none. Loops and repeated links do no harm."""
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        least = _least(down)
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        edges = materialize(small.where("u <> v").distinct(), "stars")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = now
