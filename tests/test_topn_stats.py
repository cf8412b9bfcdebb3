import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shrinkfx.operators import recode, stack, top_n
from shrinkfx.operators.stats import (activity, activity_sets, arg_extreme, box_stats, distinct_counts, distinct_sketches,
                                      histogram, kde, mean_of_counts, other_years, percentiles, shares, year_ticks)


def test_top_n_keeps_ties_and_skips_nulls(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([5.0, 4.0, 4.0, 3.0, None, 1.0])], "i int, w double")
    assert sorted(r.i for r in top_n(df, 2, "w").collect()) == [0, 1, 2]
    assert sorted(r.i for r in top_n(df, 1, "w").collect()) == [0]
    assert sorted(r.i for r in top_n(df, -2, "w").collect()) == [3, 5]
    assert sorted(r.i for r in top_n(df, 50, "w").collect()) == [0, 1, 2, 3, 5]
    assert top_n(df, 0, "w").count() == 0


def test_percentiles_match_linear_interpolation(spark):
    xs = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8]
    df = spark.createDataFrame([(x,) for x in xs], "n long")
    probs = [i / 100 for i in range(1, 101)]
    got = [r.value for r in percentiles(df, "n", probs).orderBy("prob").collect()]
    assert got == pytest.approx(list(np.quantile(xs, probs)))


def test_shares_and_mean_of_counts(spark):
    df = spark.createDataFrame([(u,) for u in [1, 1, 1, 2, 3, 3]], "u long")
    counts = df.groupBy("u").count()
    got = {r.rule: r.share for r in shares(counts, "count", [("<=1", "<=", 1), ("<3", "<", 3)]).collect()}
    assert got == {"<=1": pytest.approx(1 / 3), "<3": pytest.approx(2 / 3)}
    r = mean_of_counts(df, "u").first()
    assert r.mean_number_ratings == 2.0 and r.n_groups == 3


def test_histogram_bins_and_density(spark):
    xs = [0.0, 0.1, 0.5, 0.5, 1.0, 2.9, 2.95]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    h = histogram(df, "x", 30).orderBy("bin").collect()
    assert len(h) == 30 and sum(r.n for r in h) == len(xs)
    w = (2.95 - 0.0) / 29
    assert sum(r.density * w for r in h) == pytest.approx(1.0)
    assert h[0].x == 0.0 and h[-1].x == pytest.approx(2.95)
    # right-closed bins centred on the minimum: x in (lo + (k-0.5)w, lo + (k+0.5)w]
    for x in xs:
        k = max(0, math.ceil((x - 0.0) / w - 0.5))
        assert h[k].n >= 1


def exact_density(xs, points):
    """The statistic as defined: a sum over all values, interpolated quartiles."""
    sd, iqr = xs.std(ddof=1), np.quantile(xs, 0.75) - np.quantile(xs, 0.25)
    spread = min(sd, iqr / 1.34)
    h = 0.9 * (spread if spread > 0 else sd if sd > 0 else 1.0) * len(xs) ** -0.2
    grid = np.linspace(xs.min(), xs.max(), points)
    return grid, [np.exp(-0.5 * ((g - xs) / h) ** 2).sum() / (len(xs) * h * math.sqrt(2 * math.pi)) for g in grid]


@pytest.mark.parametrize("kind", ["normal", "outliers", "few values", "equal quartiles"])
def test_kde_equals_the_exact_sum(spark, kind):
    r = np.random.default_rng(0)
    xs = {"normal": np.round(r.normal(size=300), 3), "outliers": np.append(r.normal(size=200), [60.0, -40.0]),
          "few values": r.integers(0, 4, 150).astype(float), "equal quartiles": np.append(np.full(90, 2.0), r.normal(size=10))}[kind]
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double").repartition(3)
    out = kde(df, "x", 64).orderBy("i").collect()
    grid, want = exact_density(xs, 64)
    assert [q.x for q in out] == pytest.approx(list(grid))
    assert [q.density for q in out] == pytest.approx(want, rel=1e-11, abs=1e-15)


def test_kde_meets_only_the_grid_points_in_reach(spark):
    """Far from an outlier no kernel is summed, and the grid still has all its points."""
    df = spark.range(3000).selectExpr("CASE WHEN id = 0 THEN 1000D ELSE sin(id) END AS x")
    out = kde(df, "x", 512).orderBy("i").collect()
    assert len(out) == 512 and sum(q.density == 0 for q in out) > 400
    step = out[1].x - out[0].x
    assert step > 1  # narrower than a step: some values reach one grid point, none reaches many
    one = kde(spark.createDataFrame([(5.0,)], "x double"), "x", 8).collect()
    assert len(one) == 8 and all(q.x == 5.0 and q.density == pytest.approx(1 / (0.9 * math.sqrt(2 * math.pi))) for q in one)
    assert kde(spark.createDataFrame([], "x double"), "x").count() == 0


def test_box_stats_log10(spark):
    vals = [1, 10, 10, 100, 100, 100, 1000, 10 ** 7]
    df = spark.createDataFrame([("a", v) for v in vals], "f string, n long")
    r = box_stats(df, "f", "n").first()
    y = np.log10(vals)
    q1, med, q3 = np.quantile(y, [0.25, 0.5, 0.75])
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r.lower_whisker == pytest.approx(y[y >= lo].min())
    assert r.upper_whisker == pytest.approx(y[y <= hi].max())
    assert r.n_outliers == int(((y < lo) | (y > hi)).sum())


def test_box_whiskers_never_inside_the_box(spark):
    # 0 is an outlier and every other value sits above q1: the whisker stops at q1
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", 10.0), ("a", 10.0)], "f string, y double")
    r = box_stats(df, "f", "y", log10=False).first()
    assert r.q1 == 7.5 and r.lower_whisker == 7.5 and r.upper_whisker == 10.0 and r.n_outliers == 1


def test_year_ticks_stack_recode(spark):
    df = spark.createDataFrame([("1931",), ("1990-1991",), ("1995",), (None,)], "movie_year string")
    assert [r.tick for r in year_ticks(df).collect()] == ["1931", "1941", "1951", "1961", "1971", "1981", "1991"]
    # texts that are no year neither bound the ticks nor vanish unseen
    odd = spark.createDataFrame([("1931",), ("1990-1991",), ("",), ("",), ("1952",), (None,)], "movie_year string")
    assert [r.tick for r in year_ticks(odd).collect()] == ["1931", "1941", "1951"]
    assert {(r.text, r.n) for r in other_years(odd).collect()} == {("1990-1991", 1), ("", 2), (None, 1)}
    assert year_ticks(odd.where("movie_year = ''")).count() == 0
    a = spark.createDataFrame([(1, 2.0)], "user_id long, x double")
    b = spark.createDataFrame([("g", 3.0)], "genres string, x double")
    s = stack(a, b).collect()
    assert [tuple(r) for r in s] == [(1, 2.0, None), (None, 3.0, "g")]
    m = spark.createDataFrame([("Average",), ("Other",)], "model string")
    assert [r.model for r in recode(m, "model", {"Average": "AM"}).collect()] == ["AM", "Other"]
    assert F is not None


def test_distinct_counts_arg_extreme(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, None, 1.0), (2, "b", 1.0), (3, "b", None)], "k long, t string, x double")
    assert distinct_counts(df, ["k", "t", "x"]).first().asDict() == {"n_k": 3, "n_t": 2, "n_x": 2}
    more = distinct_counts(df, ["k", "t"], F.sum("x").alias("total"))
    assert more.first().asDict() == {"n_k": 3, "n_t": 2, "total": 4.0}
    assert (arg_extreme(df, "x", "k").first().k, arg_extreme(df, "x", "k", largest=True).first().k) == (1, 1)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation ")


def test_five_features_and_five_counts_take_one_scan(spark, tmp_path):
    rows = [(i % 7, i % 5, "abc"[i % 3], None if i % 4 == 0 else str(1990 + i % 4), i % 6, float(i % 10)) for i in range(500)]
    spark.createDataFrame(rows, "u long, m long, g string, y string, w long, rating double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    features = [("u", "U"), ("m", "M"), ("g", "G"), ("y", "Y"), ("w", "W")]
    got = activity_sets(df, features)
    want = stack(*[activity(df, k, label) for k, label in features])
    key = ["feature", "u", "m", "g", "y", "w", "number_ratings", "average_rating"]
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, want.select(key).collect()))
    assert scans(got) == 1 and scans(want) == 5
    assert scans(distinct_counts(df, ["u", "m", "g", "y", "w"])) == 1


def test_sketched_counts_keep_their_error_and_merge(spark):
    df = spark.range(60_000).selectExpr("id % 20011 AS a", "cast(id AS string) AS b", "id % 3 AS part", "CAST(NULL AS int) AS none")
    exact = distinct_counts(df, ["a", "b", "none"]).first()
    about = distinct_counts(df, ["a", "b", "none"], F.count(F.lit(1)).alias("n"), approx=True).first()
    for c in ("n_a", "n_b"):
        assert abs(about[c] - exact[c]) <= 0.05 * exact[c]  # three standard errors
    assert about.n == 60_000 and about.n_none == exact.n_none == 0
    parts = distinct_sketches(df, ["a", "b"], by=["part"])
    merged = parts.agg(F.hll_sketch_estimate(F.hll_union_agg("s_a")).alias("a")).first().a
    assert parts.count() == 3 and abs(merged - exact.n_a) <= 0.05 * exact.n_a
