import math

import pytest
from pyspark.sql import functions as F

from shrinkfx.operators import effect, fit, predict, rmse

ROWS = [  # user, movie, rating
    (1, 10, 5.0), (1, 11, 3.0), (2, 10, 4.0), (2, 12, 2.0), (3, 11, 4.0), (3, 12, 1.0),
]


@pytest.fixture
def train(spark):
    return spark.createDataFrame(ROWS, "user_id long, movie_id long, rating double")


def test_effect_alpha_0_and_5(train):
    mu = sum(r[2] for r in ROWS) / len(ROWS)
    for alpha in (0.0, 5.0):
        got = {r.movie_id: (r.n, r.effect) for r in
               effect(train, "movie_id", F.col("rating") - F.lit(mu), alpha).collect()}
        for m in (10, 11, 12):
            rs = [r[2] for r in ROWS if r[1] == m]
            assert got[m][0] == len(rs)
            assert got[m][1] == pytest.approx(sum(x - mu for x in rs) / (len(rs) + alpha))


def test_two_stage_chain_by_hand(train):
    mu = sum(r[2] for r in ROWS) / len(ROWS)
    a = 1.0
    bm = {m: sum(r[2] - mu for r in ROWS if r[1] == m) / (sum(1 for r in ROWS if r[1] == m) + a)
          for m in (10, 11, 12)}
    bu = {u: sum(r[2] - mu - bm[r[1]] for r in ROWS if r[0] == u) / (sum(1 for r in ROWS if r[0] == u) + a)
          for u in (1, 2, 3)}
    model = fit(train, ["movie_id", "user_id"], a, mu, keep=False)
    got_u = {r.user_id: r.effect for r in model.tables[1].collect()}
    assert got_u == pytest.approx(bu)
    pred = {(r.user_id, r.movie_id): r.pred for r in predict(train, model).collect()}
    for u, m, _ in ROWS:
        assert pred[(u, m)] == pytest.approx(mu + bm[m] + bu[u])


def test_unseen_keys(spark, train):
    model = fit(train, ["movie_id", "user_id"], 0.0, keep=False)
    test = spark.createDataFrame([(1, 10, 4.0), (9, 10, 3.0), (9, 99, 2.0)],
                                 "user_id long, movie_id long, rating double")
    zero = {(r.user_id, r.movie_id): (r.pred, r.n_unseen) for r in predict(test, model, "zero").collect()}
    mu = model.mu
    bm10 = [r.effect for r in model.tables[0].collect() if r.movie_id == 10][0]
    assert zero[(9, 99)] == (pytest.approx(mu), 2)
    assert zero[(9, 10)][0] == pytest.approx(mu + bm10) and zero[(9, 10)][1] == 1
    null = {(r.user_id, r.movie_id): r.pred for r in predict(test, model, "null").collect()}
    assert null[(9, 99)] is None and null[(9, 10)] is None and null[(1, 10)] is not None
    drop = predict(test, model, "drop").collect()
    assert [(r.user_id, r.movie_id) for r in drop] == [(1, 10)]
    r = rmse(predict(test, model, "null")).first()
    assert r.n == 3 and r.n_null_pred == 2


def test_null_key_is_its_own_group(spark):
    df = spark.createDataFrame([(None, 4.0), (None, 2.0), ("1990", 5.0)], "movie_year string, rating double")
    model = fit(df, ["movie_year"], 0.0, mu=3.0, keep=False)
    eff = {r.movie_year: r.effect for r in model.tables[0].collect()}
    assert eff == {None: 0.0, "1990": 2.0}
    pred = sorted(r.pred for r in predict(df, model, "drop").collect())
    assert pred == [3.0, 3.0, 5.0]


def test_large_alpha_shrinks_to_zero_and_alpha_zero_is_centred_mean(train):
    mu = 3.0
    big = effect(train, "movie_id", F.col("rating") - F.lit(mu), 1e12).collect()
    assert all(abs(r.effect) < 1e-9 for r in big)
    zero = {r.movie_id: r.effect for r in effect(train, "movie_id", F.col("rating") - F.lit(mu), 0.0).collect()}
    means = {r.movie_id: r.m for r in train.groupBy("movie_id").agg(F.avg(F.col("rating") - mu).alias("m")).collect()}
    assert zero == pytest.approx(means)


def test_rmse_formula(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "pred double, rating double")
    assert rmse(df).first().rmse == pytest.approx(math.sqrt((1 + 4) / 2))


def test_missing_ratings_weigh_nothing(spark):
    df = spark.createDataFrame([(1, 4.0), (1, None), (2, 3.0), (2, 2.0)], "movie_id long, rating double")
    got = {r.movie_id: (r.n, r.effect) for r in effect(df, "movie_id", F.col("rating") - 3.0, 0.0).collect()}
    assert got == {1: (1, 1.0), 2: (2, -0.5)}
    model = fit(df, ["movie_id"], 0.0, 3.0, keep=False)
    scored = rmse(predict(df, model)).first()
    assert scored.n == 3 and scored.n_null_pred == 0


def test_written_residuals_change_nothing(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    rows = [(int(a), int(b), int(c), int(d), int(e), float(x) / 2) for a, b, c, d, e, x in zip(
        *(rng.integers(0, k, 400) for k in (20, 30, 4, 6, 5)), rng.integers(1, 11, 400))]
    keys = ["m", "u", "g", "y", "w"]
    df = spark.createDataFrame(rows, "m long, u long, g long, y long, w long, rating double")
    kept, plain = fit(df, keys, 2.0, 3.0), fit(df, keys, 2.0, 3.0, keep=False)
    assert len(kept.paths) == 5 and plain.paths == []
    for key, a, b in zip(keys, kept.tables, plain.tables):
        x, y = ({r[key]: (r.n, round(r.effect, 10)) for r in t.collect()} for t in (a, b))
        assert x == y
