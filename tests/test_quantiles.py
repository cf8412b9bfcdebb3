import math

import numpy as np
import pytest

import shrinkfx.operators.quantiles as Q
from shrinkfx.operators.stats import approx_percentiles, box_stats, percentiles

PROBS = [0.0, 0.01, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]


def values(kind):
    r = np.random.default_rng(3)
    return {"normal": r.normal(size=3001), "many equal": np.repeat([1.0, 2.0, 2.5], [900, 5, 95]),
            "far apart": np.concatenate([10.0 ** r.uniform(-300, 300, 500), -10.0 ** r.uniform(-300, 300, 500)]),
            "outlier": np.append(r.normal(size=999), 1e18), "one": np.array([4.5]), "two": np.array([-1.0, 7.0]),
            "next to each other": 1.0 + np.arange(300) * np.finfo(float).eps}[kind]


@pytest.mark.parametrize("kind", ["normal", "many equal", "far apart", "outlier", "one", "two", "next to each other"])
def test_exact_percentiles_equal_the_sorted_definition(spark, monkeypatch, kind):
    monkeypatch.setattr(Q, "CELLS", 64)  # several rounds
    xs = values(kind)
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,), (float("nan"),)], "x double").repartition(4)
    got = {r.prob: r.value for r in percentiles(df, "x", PROBS).collect()}
    s = np.sort(xs)
    for p in PROBS:
        low, high = math.floor(p * (len(s) - 1)), math.ceil(p * (len(s) - 1))
        want = s[low] if low == high else (high - p * (len(s) - 1)) * s[low] + (p * (len(s) - 1) - low) * s[high]
        assert got[p] == pytest.approx(want, rel=1e-12)


def test_percentiles_per_group_equal_spark_and_leave_out_empty_groups(spark):
    r = np.random.default_rng(5)
    rows = [(g, float(x)) for g in ("a", "b", None) for x in r.gamma(2.0, 3.0, 700)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.prob): r.value for r in percentiles(df, "x", [0.1, 0.5], by="g").collect()}
    listed = df.where("x is not null").groupBy("g").agg({"x": "count"}).collect()
    assert {g for g, _ in got} == {r.g for r in listed}
    for g in ("a", "b", None):
        part = df.where("g is null" if g is None else f"g = '{g}'")
        want = part.selectExpr("percentile(x, array(0.1, 0.5)) AS q").first().q
        assert [got[g, 0.1], got[g, 0.5]] == pytest.approx(want, rel=1e-12)
    assert percentiles(df.where("g = 'empty'"), "x", [0.5]).count() == 0


def test_integer_counts_need_one_round(spark):
    df = spark.range(5000).selectExpr("id % 97 AS n")
    counts, found = Q.order_statistics(df, "n", lambda n: [0, n // 2, n - 1])
    assert counts == {0: 5000} and found[0] == {0: 0.0, 2500: 48.0, 4999: 96.0}


def test_approximate_percentiles_keep_their_rank_error(spark):
    df = spark.range(200_000).selectExpr("cast(id * 7 % 200000 AS double) AS x", "id % 2 AS g")
    for accuracy in (100, 2000):
        for r in approx_percentiles(df, "x", [0.1, 0.5, 0.9], accuracy=accuracy).collect():
            assert abs(r.value - r.prob * 200_000) <= 200_000 / accuracy + 1
    assert {(r.g, r.prob) for r in approx_percentiles(df, "x", [0.5], by="g").collect()} == {(0, 0.5), (1, 0.5)}


def test_box_stats_of_many_distinct_values(spark):
    xs = np.random.default_rng(1).lognormal(2, 1, 5000)
    df = spark.createDataFrame([("a", float(x)) for x in xs], "f string, n double")
    r = box_stats(df, "f", "n").first()
    assert (r.q1, r.median, r.q3) == pytest.approx(np.quantile(np.log10(xs), [0.25, 0.5, 0.75]))
    assert r.n == 5000
