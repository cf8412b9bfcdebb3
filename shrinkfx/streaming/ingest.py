"""File-stream source for ``user::movie::rating::timestamp`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shrinkfx.session import shared_dir
from shrinkfx.sources.dat import ratings_from_lines


def ratings_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed ratings from new files in ``directory``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return ratings_from_lines(reader.load(directory))


def ingest_ratings(spark: SparkSession, directory: str, table_path: str,
                   checkpoint: str | None = None, available_now: bool = True):
    """Append newly arrived rating files to the Parquet table at ``table_path``.

    With ``available_now`` the query processes what is there and stops (a
    scheduled incremental batch); otherwise it keeps running.
    """
    ckpt = checkpoint or f"{shared_dir(spark)}/shrinkfx/streams/ingest_ratings"
    w = (ratings_stream(spark, directory).writeStream.format("parquet")
         .option("path", table_path).option("checkpointLocation", ckpt).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
