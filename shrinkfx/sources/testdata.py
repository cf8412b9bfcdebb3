"""Ratings built from the driver's TPC-H-like tables (see FIXTURES.md §3).

The view plants item and user signal into ``lineitem ⋈ orders ⋈ part`` so
that effect models beat the average model. All three scans prune to the
columns used. Both joins are sort-merge joins at any size: ``orders`` and ``part``
grow with ``lineitem``, so what is shuffled grows in proportion to the rows. Rows
are numbers alone until the last join, which leaves them in even partitions sorted
by part, so that titles and genres are never shuffled with the rows and are stored
as runs of equal values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shrinkfx.functions.columns import epoch_seconds

# Row key of a rating: unique over these six columns at every scale.
HASH_KEYS = ["l_orderkey", "l_linenumber", "movie_id", "l_suppkey"]
TIE_KEYS = ["l_extendedprice", "l_quantity"]
ROW_KEYS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", epoch_seconds(F.col("l_shipdate")).alias("__shipped"))
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    pt = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type")
    j = (li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey).drop("o_orderkey")
           .join(pt.hint("merge"), li.l_partkey == pt.p_partkey))
    pk, ck = F.col("l_partkey"), F.col("o_custkey")
    qty = F.col("l_quantity").cast("int")
    score = (F.lit(35) + 3 * ((pk % 7) - 3) + 2 * ((ck % 5) - 2)
             + 2 * ((qty % 11) - 5) + F.floor((pk % 80) / F.lit(40.0)))
    rating = (F.greatest(F.lit(1), F.least(F.lit(10), F.floor(score / F.lit(5.0)).cast("int")))
              .cast("double") / F.lit(2.0))
    # a tail of keys that occur once or a few times, so hold-outs meet unknown ones
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    user = F.when(ok % 97 == 0, F.lit(10_000_000) + ok).otherwise(ck)
    movie = F.when((ok * 7 + ln) % 101 == 0, F.lit(10_000_000) + pk * 1000 + ok % 1000).otherwise(pk)
    late = F.when((ok + ln) % 103 == 0, (ok % 997) * F.lit(1_209_600)).otherwise(F.lit(0))
    title = (F.when(pk % 97 == 0, F.col("p_name"))
              .when(pk % 89 == 0, F.concat(F.col("p_name"), F.lit(" (1990-1991)")))
              .otherwise(F.concat(F.col("p_name"), F.lit(" ("),
                                  (F.lit(1930) + pk % 80).cast("string"), F.lit(")"))))
    return j.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity",
        user.alias("user_id"),
        movie.alias("movie_id"),
        rating.alias("rating"),
        (F.col("__shipped") + ln * 14400 + late).cast("long").alias("ts"),
        title.alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
    )
