"""Stage tables: save a DataFrame for later reuse and load it back (Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_stage(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
