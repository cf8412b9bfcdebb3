"""``::``-delimited ratings and movies files.

ratings: ``user::movie::rating::timestamp``; movies: ``movie::title::genres``
where a movie line is split into at most three parts, so a later ``::`` stays
inside the genres text, and missing parts become empty strings. Files are
read in parallel splits by the executors; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEP = "::"

RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])


def _split_parts(value, limit: int) -> list:
    parts = F.split(value, F.lit(SEP), limit)
    return [F.coalesce(F.get(parts, i), F.lit("")) for i in range(limit)]


def ratings_from_lines(lines: DataFrame) -> DataFrame:
    """Parse a one-column (``value``) DataFrame of rating lines, batch or stream. An
    unparsable number becomes NULL (never an error); ``rejected`` counts such lines."""
    p = _split_parts(F.col("value"), 4)
    return lines.select(
        p[0].try_cast("bigint").alias("user_id"),
        p[1].try_cast("bigint").alias("movie_id"),
        p[2].try_cast("double").alias("rating"),
        p[3].try_cast("bigint").alias("ts"),
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return ratings_from_lines(spark.read.text(path))


def rejected(ratings: DataFrame) -> DataFrame:
    """``(n_lines, n_rejected)``: lines, and those of which some field is no number."""
    bad = F.greatest(*[F.col(c).isNull().cast("int") for c in RATINGS_SCHEMA.names])
    return ratings.agg(F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum(bad), F.lit(0)).alias("n_rejected"))


def movies_from_lines(lines: DataFrame) -> DataFrame:
    """Parse a one-column (``value``) DataFrame of movie lines."""
    p = _split_parts(F.col("value"), 3)
    return lines.select(
        p[0].try_cast("bigint").alias("movie_id"),
        p[1].alias("title"),
        p[2].alias("genres"),
    )


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return movies_from_lines(spark.read.text(path))


def _number_text(c) -> F.Column:
    # 5.0 -> "5", 4.5 -> "4.5" (the file format writes whole ratings bare)
    s = c.cast("string")
    return F.regexp_replace(s, r"\.0$", "")


def write_ratings_dat(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws(SEP, F.col("user_id").cast("string"),
                          F.col("movie_id").cast("string"),
                          _number_text(F.col("rating")),
                          F.col("ts").cast("string")).alias("value")
              ).write.mode("overwrite").text(path)


def write_movies_dat(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws(SEP, F.col("movie_id").cast("string"), F.col("title"),
                          F.col("genres")).alias("value")
              ).write.mode("overwrite").text(path)
