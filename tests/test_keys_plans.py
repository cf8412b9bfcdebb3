"""Keyed joins, and the shape of the physical plans that matter at scale."""

from pyspark.sql import functions as F

from shrinkfx.operators import attach, drop_present, keep_known
from shrinkfx.operators import sweep as SW
from shrinkfx.operators.split import stratified_split


def plan(df):
    df.write.format("noop").mode("overwrite").save()  # let AQE finish the plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_attach_null_safe_left_and_inner(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "i int, k string")
    t = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, e double")
    inner = sorted((r.i, r.e) for r in attach(df, t, "k", "inner").collect())
    left = sorted((r.i, r.e) for r in attach(df, t, "k", "left").collect())
    assert inner == [(1, 1.0), (2, 2.0)]
    assert left == [(1, 1.0), (2, 2.0), (3, None)]
    assert attach(df, t, "k").columns == ["i", "k", "e"]


def test_self_join_lineage_is_not_ambiguous(spark):
    df = spark.createDataFrame([(1, 10, 2.0), (2, 10, 4.0)], "u int, m int, r double")
    eff = df.groupBy("m").agg(F.avg("r").alias("e"))
    assert sorted(r.e for r in attach(df, eff, "m").collect()) == [3.0, 3.0]


def test_drop_present_removes_every_copy_and_matches_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "a int, b string")
    other = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert [tuple(r) for r in drop_present(df, other).collect()] == [(3, "y")]
    assert sorted(r.a for r in keep_known(df, other, ["a"]).collect()) == [1, 1, 2]


def test_split_is_a_predicate_on_one_scan(spark, tmp_path):
    rows = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("double").alias("y"))
    rows.write.parquet(f"{tmp_path}/rows")
    p = plan(stratified_split(spark.read.parquet(f"{tmp_path}/rows"), "y", 0.1, "1", ["k"], [], "value"))
    assert p.count("FileScan parquet") == 1
    assert not any(x in p for x in ("Window", "Exchange", "Join", "Union"))


def test_chain_sweep_moves_no_array_with_a_row(spark):
    """With broadcast joins off, what crosses an exchange is thin rows, before they meet the
    grid, and partial sums."""
    rows = spark.range(4000).select(
        (F.col("id") % 500).alias("user_id"), (F.col("id") % 40).alias("movie_id"), (F.col("id") % 7).alias("genres"),
        ((F.col("id") % 9) / 2 + 1).alias("rating"), F.col("id").alias("row_id"))
    sweep = SW.ChainSweep(rows.where("row_id % 5 > 0"), rows.where("row_id % 5 = 0"), ["movie_id", "user_id", "genres"], 3.0,
                          hot_share=1 / 400)
    grid = SW.Grid([0.0, 1.0, 2.0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met, _ = sweep._second(grid)
        sums = sweep._residuals(met, grid)
        sums.write.format("noop").mode("overwrite").save()
        jplan = sums._jdf.queryExecution().executedPlan()
        found = []

        def walk(node):
            if node.nodeName() == "AdaptiveSparkPlan":
                return walk(node.executedPlan())
            if node.nodeName().endswith("QueryStage"):
                return walk(node.plan())
            if node.nodeName() == "Exchange":
                found.append(node.schema().simpleString())
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        walk(jplan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found and not any("array" in f for f in found), found
    data = [f for f in found if "d:double" in f]
    assert data and not any(f":{kind}" in f for f in data for kind in ("struct", "map")) and all(f.count(":") <= 8 for f in data), data
    assert not any("a0" in f for f in data)  # the grid comes after
