import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from shrinkfx.plans import catalog
from shrinkfx.plans import experiment as X
from shrinkfx.plans.oracles import ORACLES

SF001 = "/root/testdata/sf0.001"

ORACLE_SAMPLE = ["stratified_split_10", "stratified_split_20", "closed_test", "semi_known_keys",
                 "anti_removed_rows", "edx_with_moved_back",
                 "model_mugyw", "leaderboard", "model_summary", "final_validation_rmse",
                 "best_worst_movies", "boxplot_activity", "kde_user_avg", "hist_movie_avg",
                 "user_activity_percentiles", "quietest_12_months", "predict_with_unseen"]


@pytest.fixture(scope="module")
def prepared(spark):
    return X.prepare(spark, SF001)


def test_split_counts_add_up(prepared):
    p = prepared
    assert p.edx.count() + p.validation.count() == p.ratings.count()
    assert p.train.count() + p.test_open.count() == p.edx.count()
    assert p.moved_back.count() + p.validation.count() == p.split1.filter("is_test").count()


def test_closed_test_keys_are_known(prepared):
    p = prepared
    for k in X.FULL_CHAIN:
        missing = p.test.select(k).subtract(p.train.select(k)).count()
        assert missing == 0, k


def test_leaderboard_shape_and_signal(spark, prepared):
    lb = X.leaderboard(prepared).toPandas()
    assert len(lb) == 1 + 9 * 121
    assert sorted(lb.ordinal) == list(range(1, 1 + 1 + 9 * 121))
    avg = lb[lb.model == X.AVERAGE].rmse.iloc[0]
    best_movie = lb[lb.model == "Movie Effect Model"].rmse.min()
    best_mu = lb[lb.model == "Movie + User Effect Model"].rmse.min()
    assert avg > best_movie > best_mu
    b = X.best(X.leaderboard(prepared)).first()
    assert b.rmse == lb.rmse.min()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["model", "best_rmse", "best_alpha", "worst_rmse", "worst_alpha", "average_rmse"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(ORACLES)
    assert set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_duckdb_oracle(spark, name):
    con = duckdb.connect()
    for t in ["lineitem", "orders", "part"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    cols = sorted(got.columns)

    def canon(df):
        out = []
        for r in df[cols].itertuples(index=False):
            row = []
            for v in r:
                if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
                    row.append("NULL")
                elif isinstance(v, float):
                    row.append(str(int(v)) if v.is_integer() else repr(round(v, 6)))
                else:
                    row.append(str(v))
            out.append("|".join(row))
        return sorted(out)

    assert canon(got) == canon(want)


def test_move_back_and_closing_on_withheld_keys(spark, prepared):
    """Test-only fixture: every row of some movies / users is held out, so the
    hold-out must lose them and move them back (checked against DuckDB)."""
    from pyspark.sql import functions as F

    from shrinkfx.operators import close_holdout, split_with_return

    flagged = prepared.split1.withColumn(
        "is_test", F.col("is_test") | (F.col("movie_id") % 50 == 0) | (F.col("user_id") % 40 == 0))
    ho = split_with_return(flagged, ["movie_id", "user_id"])
    pdf = flagged.toPandas()
    con = duckdb.connect()
    con.register("f", pdf)
    want_back = con.execute("""
        SELECT * EXCLUDE (is_test) FROM f t WHERE is_test AND NOT (
            movie_id IN (SELECT movie_id FROM f WHERE NOT is_test) AND
            user_id IN (SELECT user_id FROM f WHERE NOT is_test))""").df()
    got_back = ho.moved_back.toPandas()
    assert len(want_back) > 0
    key = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]
    assert sorted(map(tuple, got_back[key].values.tolist())) == sorted(map(tuple, want_back[key].values.tolist()))
    assert ho.holdout.count() + ho.moved_back.count() == int(pdf.is_test.sum())
    assert ho.train.count() == len(pdf) - ho.holdout.count()
    # closing a test set against a train that lacks some weeks
    train = prepared.train.filter(F.col("rating_week") % 3 != 0)
    closed = close_holdout(prepared.test, train, ["movie_id", "user_id", "genres", "rating_week", "movie_year"])
    bad = closed.join(train.select("rating_week").distinct(), "rating_week", "left_anti").count()
    assert bad == 0 and closed.count() < prepared.test.count()


def test_experiment_from_dat_files(spark, prepared):
    """A user's path: ratings.dat + movies.dat -> prepare -> sweep -> best -> refit."""
    import os
    import tempfile

    from pyspark.sql import functions as F

    from shrinkfx.sources import write_movies_dat, write_ratings_dat

    d = tempfile.mkdtemp(prefix="shrinkfx-ml-")
    src = prepared.ratings
    # one rating per (user, movie, ts) so the default row key is unique
    one = src.groupBy("user_id", "movie_id", "ts").agg(F.first("rating").alias("rating"))
    write_ratings_dat(one, os.path.join(d, "ratings"))
    write_movies_dat(src.select("movie_id", "title", "genres").distinct(), os.path.join(d, "movies"))
    rows = X.load_ratings_files(spark, os.path.join(d, "ratings"), os.path.join(d, "movies"))
    assert rows.count() == one.count()
    p = X.prepare_ratings(rows, X.Config(grid=(0.0, 10.0, 5.0)))
    assert p.train.count() + p.test_open.count() == p.edx.count()
    lb = X.leaderboard(p, [0.0, 5.0, 10.0])
    assert lb.count() == 1 + 9 * 3
    b = X.best(lb).first()
    final = X.final_validation(p, b.model, b.alpha).first()
    assert final.n == p.validation.count() and final.rmse < 1.5


def test_prepare_from_a_stored_table_without_restaging(spark, prepared):
    p = X.prepare_ratings(prepared.ratings, X.Config(), ["l_orderkey", "l_linenumber", "movie_id", "l_suppkey"],
                          ["l_extendedprice", "l_quantity"], stage_source=False)
    # same source, same keys and seeds as the driver-data path -> the same split
    assert p.test.exceptAll(prepared.test).count() == 0 and p.test.count() == prepared.test.count()
    assert p.mu == prepared.mu


def test_best_and_summary_ties_take_the_first_ordinal(spark):
    rows = [(1, X.AVERAGE, None, 0.9), (2, "Movie Effect Model", 0.0, 0.7), (3, "Movie Effect Model", 0.5, 0.6),
            (4, "Movie Effect Model", 1.0, 0.6), (5, "Movie Effect Model", 1.5, 0.8), (6, "Movie Effect Model", 2.0, 0.8),
            (7, "User Effect Model", 0.0, 0.6)]
    lb = spark.createDataFrame(rows, "ordinal bigint, model string, alpha double, rmse double")
    b = X.best(lb).first()
    assert (b.ordinal, b.model, b.alpha) == (3, "Movie Effect Model", 0.5)
    s = {r.model: r for r in X.summary(lb).collect()}
    mm = s["MM"]
    assert (mm.best_rmse, mm.best_alpha, mm.worst_rmse, mm.worst_alpha) == (0.6, 0.5, 0.8, 1.5)
    assert mm.average_rmse == pytest.approx((0.7 + 0.6 + 0.6 + 0.8 + 0.8) / 5)
    am = s["AM"]
    assert am.best_rmse == 0.9 and am.best_alpha is None and am.worst_rmse is None and am.average_rmse is None


def test_withheld_keys_occur_in_the_driver_data(spark, prepared):
    """The view's tail of rare keys makes closing, moving back and unseen effects happen."""
    assert prepared.moved_back.count() > 0
    assert prepared.test.count() < prepared.test_open.count()
    unseen = E.queries()["predict_with_unseen"](spark, SF001)
    assert unseen.agg({"n_unseen": "sum"}).first()[0] > 0


def test_cache_tells_hash_keys_and_configurations_apart(spark, prepared):
    src = prepared.ratings.limit(400)
    a, b = (X.prepare_ratings(src, X.Config(), keys, ["l_extendedprice"], cache_key="same", spark=spark)
            for keys in (["l_orderkey", "l_suppkey"], ["movie_id", "user_id"]))
    assert a.paths["split2"] != b.paths["split2"]
    again = X.prepare_ratings(src, X.Config(), ["l_orderkey", "l_suppkey"], ["l_extendedprice"], cache_key="same", spark=spark)
    assert again.paths == a.paths
    assert {r.l_orderkey for r in a.split1.where("is_test").collect()} != {r.l_orderkey for r in b.split1.where("is_test").collect()}


def test_preview_and_rejected_rows_on_loaded_ratings(spark, prepared):
    from pyspark.sql import functions as F

    from shrinkfx.plans import report as R
    rows = prepared.ratings.select("user_id", "movie_id", "rating", "ts", "title", "genres").limit(300)
    rows = rows.unionByName(rows.limit(3).withColumn("rating", F.lit(None).cast("double")))
    p = X.prepare_ratings(rows)
    assert p.n_rejected == 3 and p.edx.count() + p.validation.count() == 300
    got = R.train_preview(p, 3).collect()
    assert len(got) == 3 and got == sorted(got, key=lambda r: (r.user_id, r.movie_id, r.rated_at))


def test_train_is_read_by_partition_pruning_without_hashing(prepared):
    for df in (prepared.train, prepared.test_open, prepared.train.groupBy("user_id").count()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "md5" not in plan and "PartitionFilters: [isnotnull(is_test" in plan
    for df in (prepared.split1, prepared.validation, prepared.edx):
        assert "md5" not in df._jdf.queryExecution().executedPlan().toString()


def test_leaderboard_goes_on_where_it_was_lost(spark, prepared, tmp_path, monkeypatch):
    folder, cfg, alphas = f"file://{tmp_path}/lb", X.Config(alpha_batch=3), [0.0, 1.0, 2.5, 5.0, 10.0]
    whole = sorted(map(tuple, X.leaderboard(prepared, alphas, cfg, folder).collect()), key=str)
    assert len(whole) == 1 + 9 * len(alphas)
    names = {d.name for d in (tmp_path / "lb").iterdir() if d.name.startswith("chunk=")}
    assert names == {f"chunk={n}" for n in ("average", "UM", "MM", "GM", "YM", "RM", "chain-0", "chain-1")}
    # the writers of a family and of one run of alphas are lost
    for lost in ("GM", "chain-1"):
        (tmp_path / "lb" / f"chunk={lost}" / "_SUCCESS").unlink()
    swept, single = [], []
    real, one = X.ChainSweep.scores, X.sweep_single
    monkeypatch.setattr(X.ChainSweep, "scores", lambda self, part: (swept.append(part), real(self, part))[1])
    monkeypatch.setattr(X, "sweep_single", lambda *a: (single.append(a[2]), one(*a))[1])
    again = sorted(map(tuple, X.leaderboard(prepared, alphas, cfg, folder).collect()), key=str)
    assert swept == [[5.0, 10.0]] and single == ["genres"]
    assert [r[:3] for r in again] == [r[:3] for r in whole]
    assert [r[3] for r in again] == pytest.approx([r[3] for r in whole], rel=1e-12)
    with pytest.raises(ValueError, match="other inputs or settings"):
        X.leaderboard(prepared, alphas[:-1], cfg, folder)


def _view_tables(spark, folder, copies=1):
    """Four parts, orders and line items in the test data's schema, each row ``copies`` times."""
    from pyspark.sql import functions as F
    n = spark.range(copies).select(F.lit(1).alias("__x"))
    for name, rows, schema in (
            ("part", [(k, f"part {k}", f"Brand#{k}", "STANDARD") for k in range(1, 5)],
             "p_partkey bigint, p_name string, p_brand string, p_type string"),
            ("orders", [(k, k % 3 if k != 7 else None) for k in range(1, 41)], "o_orderkey bigint, o_custkey bigint"),
            ("lineitem", [(k, (k + i) % 5 + 1 if k != 9 else None, k % 4, i, float(k % 50), k * 1.5, f"1995-0{k % 9 + 1}-11 00:00:00")
                          for k in range(1, 41) for i in (1, 2, 3)],
             "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
             "l_extendedprice double, l_shipdate string")):
        df = spark.createDataFrame(rows, schema).crossJoin(n).drop("__x")
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return f"file://{folder}"


@pytest.mark.parametrize("copies", [1, 2])
def test_view_moves_thin_rows_in_the_same_plan_at_any_size(spark, tmp_path, copies):
    from shrinkfx.sources import ratings_view
    from shrinkfx.sources.testdata import HASH_KEYS, TIE_KEYS
    view = ratings_view(spark, _view_tables(spark, tmp_path, copies))
    plan = view._jdf.queryExecution().executedPlan().toString()
    # a plan that changes with the tables' sizes makes the shuffled bytes grow faster than they do
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    from shrinkfx.plans.duckdb_sql import BASE_COLS, RATINGS_VIEW
    want = con.execute(f"SELECT {BASE_COLS} FROM ({RATINGS_VIEW})").fetchall()
    got = [tuple(r) for r in view.selectExpr(*BASE_COLS.split(", ")).collect()]
    assert len(got) > 0 and sorted(got, key=str) == sorted(want, key=str)
    # rows come out of the last join in order of the part: no shuffle of whole rows before the write
    p = X.prepare_ratings(view, X.Config(), HASH_KEYS, TIE_KEYS, even=True)
    q = X.prepare_ratings(view, X.Config(), HASH_KEYS, TIE_KEYS)
    assert sorted(map(tuple, p.split2.collect()), key=str) == sorted(map(tuple, q.split2.collect()), key=str)


def test_stored_source_holds_no_hashes(spark, prepared):
    for name in ("ratings", "heldout_tagged"):
        stored = spark.read.parquet(prepared.paths[name])
        assert not [c for c, kind in stored.dtypes if kind == "binary"], name
