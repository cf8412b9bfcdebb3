"""Incremental ingestion of ratings files with Structured Streaming.

The reference is a batch workload and has no streaming operator; this module
only lets the same ``::`` parser run over a directory that keeps receiving
files (e.g. daily rating dumps), appending typed rows to a Parquet table
that the batch plans then read. Exactly-once comes from the checkpoint
location, which lives in the shared folder (``spark.checkpoint.dir``).
"""

from shrinkfx.streaming.ingest import ingest_ratings, ratings_stream

__all__ = ["ingest_ratings", "ratings_stream"]
