import pytest

from shrinkfx import session


class _Fake:
    """A session on a cluster, without the shared folder."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = {"spark.checkpoint.dir": folder} if folder else {}, self
        self.master = master

    def getCheckpointDir(self):
        return None



@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_the_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Fake(master))
    assert session.shared_dir(_Fake(master, "hdfs://x/y/")) == "hdfs://x/y"


def test_stage_returns_table_and_folder(spark):
    df, path = session.stage(spark.range(5), "five")
    assert path.startswith(session.shared_dir(spark)) and spark.read.parquet(path).count() == df.count() == 5
    assert session.path_exists(spark, path) and not session.path_exists(spark, path + "-not")


def test_stage_parted_by_a_column_keeps_types_and_prunes(spark):
    df = spark.range(10).selectExpr("id", "id % 3 = 0 AS flag", "cast(id AS string) AS t")
    out, path = session.stage(df, "parted", "flag")
    assert out.dtypes == [("id", "bigint"), ("t", "string"), ("flag", "boolean")]
    part = out.where("flag")
    assert sorted(r.id for r in part.collect()) == [0, 3, 6, 9] and session.path_exists(spark, path)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flag" in plan and len(part.inputFiles()) < len(out.inputFiles()) + 1


def test_chunks_resume_and_refuse_other_inputs(spark, tmp_path):
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    for again in range(2):
        store = session.Chunks(spark, f"file://{tmp_path}/c", {"a": 1})
        assert [store.get(str(n), lambda: build(n)).count() for n in (2, 3)] == [2, 3]
    assert built == [2, 3]
    (tmp_path / "c" / "chunk=3" / "_SUCCESS").unlink()  # a writer that was lost before its end
    assert store.get("3", lambda: build(3)).count() == 3 and built == [2, 3, 3]
    with pytest.raises(ValueError, match="other inputs"):
        session.Chunks(spark, f"file://{tmp_path}/c", {"a": 2})


def test_folders_by_value_are_written_without_sorting_the_rows(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    conf, seen, real = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(conf)), real(self, path))[1])
    before = spark.conf.get(conf)
    df, path = session.stage(spark.range(1000).selectExpr("id", "id % 5 = 0 AS held"), "held", "held")
    assert seen == [str(session.OPEN_FOLDERS)] and int(seen[0]) >= 2 and spark.conf.get(conf) == before
    assert df.where("held").count() == 200 and df.where("not held").count() == 800
    # more values than folders open side by side: the rest is sorted, nothing is lost
    many, _ = session.stage(spark.range(1000).selectExpr("id", "id % 37 AS part"), "many", "part")
    assert sorted(r.id for r in many.collect()) == list(range(1000))
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        session.stage(spark.range(1), "none", "id")
    assert spark.conf.get(conf) == before
