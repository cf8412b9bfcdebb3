import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import shrinkfx.operators.sweep as SW
from shrinkfx.operators import fit, fit_chain_arrays, predict, rmse, sweep_chain, sweep_single

CHAIN = ["movie_id", "user_id", "genres", "week"]
ALPHAS = [0.0, 0.5, 3.0, 25.0]


def frames(spark, n=1500, seed=1):
    rng = np.random.default_rng(seed)
    movie = rng.integers(0, 60, n)
    pdf = pd.DataFrame({
        "row_id": np.arange(n),
        "user_id": np.where(rng.random(n) < 0.33, 0, rng.integers(1, 200, n)),  # one hot user
        "movie_id": movie,
        "genres": np.array(["a", "b", "c", None], dtype=object)[movie % 4],
        "week": rng.integers(0, 12, n),
        "rating": rng.integers(1, 11, n) / 2.0,
    })
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "row_id long, user_id long, movie_id long, genres string, week long, rating double")
    train = df.filter(F.col("row_id") % 5 != 0)
    test = df.filter(F.col("row_id") % 5 == 0)
    return train, test


def direct(train, test, chain, alpha, mu):
    m = fit(train, chain, alpha, mu, keep=False)
    r = rmse(predict(test, m, unseen="drop")).first()
    return r.n, r.rmse


def test_sweep_single_equals_direct_fit(spark):
    train, test = frames(spark)
    mu = train.agg(F.avg("rating")).first()[0]
    for key in ["user_id", "genres"]:
        got = {r.alpha: (r.n, r.rmse) for r in sweep_single(train, test, key, ALPHAS, mu).collect()}
        for a in ALPHAS:
            n, e = direct(train, test, [key], a, mu)
            assert got[a][0] == n and got[a][1] == pytest.approx(e, rel=1e-9)


@pytest.mark.parametrize("hot_share", [SW.HOT_SHARE, 0.05, 1.0], ids=["all hot", "one hot", "none hot"])
def test_sweep_chain_equals_direct_fit(spark, hot_share):
    train, test = frames(spark)
    mu = train.agg(F.avg("rating")).first()[0]
    got = {(r.stage, r.alpha): (r.n, r.rmse)
           for r in sweep_chain(train, test, CHAIN, ALPHAS, mu, hot_share=hot_share).collect()}
    assert len(got) == len(CHAIN) * len(ALPHAS)
    for s in range(1, len(CHAIN) + 1):
        for a in ALPHAS:
            n, e = direct(train, test, CHAIN[:s], a, mu)
            assert got[(s, a)][0] == n
            assert got[(s, a)][1] == pytest.approx(e, rel=1e-9)


@pytest.mark.parametrize("hot_share", [SW.HOT_SHARE, 0.05, 1.0])
def test_chain_arrays_equal_one_fit_per_alpha(spark, hot_share):
    train, _ = frames(spark)
    mu = 3.0
    tables = fit_chain_arrays(train, CHAIN, ALPHAS, mu, hot_share=hot_share)
    for i, a in enumerate(ALPHAS):
        model = fit(train, CHAIN, a, mu, keep=False)
        for key, got, want in zip(CHAIN, tables, model.tables):
            g = {r[key]: (r.n, r.eff[i]) for r in got.collect()}
            w = {r[key]: (r.n, r.effect) for r in want.collect()}
            assert g.keys() == w.keys()
            for k in w:
                assert g[k][0] == w[k][0] and g[k][1] == pytest.approx(w[k][1], rel=1e-9, abs=1e-11)


def test_sweep_leaves_out_rows_without_a_rating(spark):
    train, test = frames(spark, n=400)
    holes = train.unionByName(train.limit(50).withColumn("rating", F.lit(None).cast("double")))
    a = {(r.stage, r.alpha): (r.n, r.rmse) for r in sweep_chain(train, test, CHAIN, ALPHAS, 3.0).collect()}
    b = {(r.stage, r.alpha): (r.n, r.rmse) for r in sweep_chain(holes, test, CHAIN, ALPHAS, 3.0).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], rel=1e-12)


def test_alpha_grid(spark):
    assert [r.alpha for r in SW.alpha_grid(spark, 0, 30, 0.25).collect()] == SW.grid_values(0, 30, 0.25)
    assert len(SW.grid_values()) == 121 and SW.grid_values()[-1] == 30.0


def test_batched_alphas_equal_one_pass(spark):
    train, test = frames(spark, n=800)
    mu = 3.0
    alphas = [0.0, 0.25, 1.0, 4.0, 9.0]
    one = {(r.stage, r.alpha): r.rmse for r in SW.sweep_chain_batched(train, test, CHAIN, alphas, mu).collect()}
    two = {(r.stage, r.alpha): r.rmse for r in SW.sweep_chain_batched(train, test, CHAIN, alphas, mu, batch=2).collect()}
    assert one.keys() == two.keys() and len(one) == len(CHAIN) * len(alphas)
    for k in one:
        assert one[k] == pytest.approx(two[k], rel=1e-12)


def operators_of(df):
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.sub(r"\[[^\]]*\]|\d+", "", "\n".join(line.split()[0] if line.split() else "" for line in plan.replace(":", " ").replace("+-", " ").splitlines())), plan.count("sum(")


def test_the_plan_does_not_grow_with_the_grid(spark):
    import time
    train, test = frames(spark, n=300)
    sweep, shape, took = SW.ChainSweep(train, test, CHAIN, 3.0), {}, {}
    for n in (3, 121, 1210):
        t = time.time()
        out = sweep.scores([i / 4 for i in range(n)])
        took[n], shape[n] = time.time() - t, operators_of(out)
        assert out.count() == len(CHAIN) * n
    assert shape[3] == shape[121] == shape[1210]


def test_a_grid_that_fills_no_whole_block_and_one_alpha(spark):
    train, test = frames(spark, n=400)
    whole = {(r.stage, r.alpha): r.rmse for r in sweep_chain(train, test, CHAIN, [i / 2 for i in range(33)], 3.0).collect()}
    assert len(whole) == 33 * len(CHAIN)
    for alphas in ([0.5], [i / 2 for i in range(17)], [9.0, 2.5, 0.0]):
        got = {(r.stage, r.alpha): r.rmse for r in sweep_chain(train, test, CHAIN, alphas, 3.0).collect()}
        assert set(got) == {(s, a) for s in range(1, len(CHAIN) + 1) for a in alphas}
        for k, v in got.items():
            assert v == pytest.approx(whole[k], rel=1e-12)


@pytest.mark.parametrize("length", [1, 2, 3])
def test_short_chains(spark, length):
    train, test = frames(spark, n=500)
    got = {(r.stage, r.alpha): (r.n, r.rmse) for r in sweep_chain(train, test, CHAIN[:length], ALPHAS, 3.0).collect()}
    for s in range(1, length + 1):
        for a in ALPHAS:
            n, e = direct(train, test, CHAIN[:s], a, 3.0)
            assert got[s, a][0] == n and got[s, a][1] == pytest.approx(e, rel=1e-9)


def test_rows_are_joined_with_the_first_effect_once(spark):
    train, test = frames(spark)
    sweep = SW.ChainSweep(train, test, CHAIN, 3.0)
    plan = sweep.rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "parquet" in plan and "k0" not in sweep.rows.columns
