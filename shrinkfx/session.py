"""Session helpers: recommended configuration and the shared stage store.

Stage tables (split outputs, effect tables) are written as Parquet below the
folder named by ``spark.checkpoint.dir``. On a cluster that folder must be set to
shared storage; only a local master may do without it, and then a scratch folder
is made. ``drop_stages`` removes what a run has written.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN_ID = uuid.uuid4().hex[:12]

#: Folders that a task writes side by side; with more values than that it sorts its rows.
OPEN_FOLDERS = 4
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def get_spark(master: str | None = None, app: str = "shrinkfx",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables: ``spark.checkpoint.dir``.

    Unset on a cluster it is an error: a folder of the driver's machine would hold
    only what tasks on that machine write."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to shared storage (master is {master})")
        d = tempfile.mkdtemp(prefix="shrinkfx-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/shrinkfx/{_RUN_ID}/{name}-{uuid.uuid4().hex[:8]}"


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet stage table in the shared folder; the table and its folder.

    This cuts the lineage (a lost executor re-reads the table instead of
    recomputing the plan) and lets later stages prune columns and push
    filters into the scan. Callers that keep a table keep the folder's path.
    With ``partition_by`` each value of that column has a folder, and a filter on it
    reads the matching folders alone; the column comes last. A task writes the folders of
    up to ``OPEN_FOLDERS`` values side by side instead of sorting whole rows by that column,
    which would spill where a task's rows are larger than its memory.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        before = spark.conf.get(_WRITERS, None)
        spark.conf.set(_WRITERS, str(OPEN_FOLDERS))
        try:
            writer.partitionBy(partition_by).parquet(path)
        finally:
            spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)
    else:
        writer.parquet(path)
    # the values in folder names are texts: the types are given, not guessed
    kept = df.select(*[c for c in df.columns if c != partition_by], *([partition_by] if partition_by else []))
    return spark.read.schema(kept.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for callers that need the table alone."""
    return stage(df, name)[0]


def _found(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path in whatever store it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_stages(spark: SparkSession) -> bool:
    """Delete this process's stage tables (when a run has saved its results)."""
    fs, path = _found(spark, f"{shared_dir(spark)}/shrinkfx/{_RUN_ID}")
    return fs.delete(path, True)


def drop_table(spark: SparkSession, path: str) -> bool:
    """Delete one stage table, which nothing reads any more."""
    fs, found = _found(spark, path)
    return fs.delete(found, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stage table is still there, on any store: its writer's ``_SUCCESS`` mark is."""
    fs, mark = _found(spark, f"{path}/_SUCCESS")
    return fs.exists(mark)


class Chunks:
    """Results written piece by piece below a folder, so that a job that was lost midway goes
    on where it was. ``describe`` says what the pieces are made from; a folder that holds
    pieces made from something else is refused."""

    def __init__(self, spark: SparkSession, folder: str, describe: dict):
        self.spark, self.folder = spark, folder.rstrip("/")
        said = json.dumps(describe, sort_keys=True)
        manifest = f"{self.folder}/manifest"
        if not path_exists(spark, manifest):
            spark.createDataFrame([(said,)], "made_from string").coalesce(1).write.mode("overwrite").parquet(manifest)
        elif spark.read.parquet(manifest).first()["made_from"] != said:
            raise ValueError(f"{self.folder} holds results of other inputs or settings")

    def path(self, name: str) -> str:
        return f"{self.folder}/chunk={name}"

    def done(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def get(self, name: str, build) -> DataFrame:
        """The piece ``name``: read if it was written to the end, else ``build()`` is written."""
        if not self.done(name):
            build().write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))
