import hashlib
import math

import numpy as np
import pandas as pd
import pytest

import shrinkfx.operators.split as SP
from shrinkfx.operators import close_holdout, split_with_return, stratified_split


def brute_force(pdf, p, seed, by):
    """Textbook form: rank inside each stratum by (md5, ties), keep ceil(p * n)."""
    pdf = pdf.copy()
    pdf["h"] = [hashlib.md5(f"{seed}-{a}-{b}".encode()).hexdigest() for a, b in zip(pdf.k1, pdf.k2)]
    if by == "value":
        pdf["s"] = pdf.y
    else:
        lo = pdf.y.min()
        qs = np.quantile(pdf.y, [0.25, 0.5, 0.75])  # linear interpolation (type 7)
        pdf["s"] = sum(((q > lo) & (pdf.y > q)).astype(int) for q in qs)
    pdf = pdf.sort_values(["s", "h", "t"])
    pdf["rn"] = pdf.groupby("s").cumcount() + 1
    pdf["cnt"] = pdf.groupby("s").y.transform("size")
    pdf["is_test"] = pdf.rn <= np.ceil(p * pdf.cnt)
    return dict(zip(zip(pdf.k1, pdf.k2), pdf.is_test))


def make(n, seed=7, values=(1.0, 2.0, 3.0, 3.5, 4.0, 4.0, 4.0, 5.0)):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"k1": np.arange(n) // 3, "k2": np.arange(n) % 3,
                         "y": rng.choice(values, n), "t": rng.integers(0, 5, n).astype(float)})


@pytest.mark.parametrize("by", ["value", "quartile"])
@pytest.mark.parametrize("p", [0.1, 0.2, 0.5])
def test_split_equals_brute_force(spark, by, p):
    pdf = make(3000)
    df = spark.createDataFrame(pdf)
    got = {(r.k1, r.k2): r.is_test for r in
           stratified_split(df, "y", p, "9", ["k1", "k2"], ["t"], by).collect()}
    assert got == brute_force(pdf, p, "9", by)


def test_split_with_tiny_buckets_exercises_boundary_ranking(spark, monkeypatch):
    # one hex digit = 16 buckets: many rows share the boundary bucket
    monkeypatch.setattr(SP, "BUCKET_HEX_DIGITS", 1)
    pdf = make(2000, seed=3)
    got = {(r.k1, r.k2): r.is_test for r in
           stratified_split(spark.createDataFrame(pdf), "y", 0.3, "x", ["k1", "k2"], ["t"], "value").collect()}
    assert got == brute_force(pdf, 0.3, "x", "value")


def test_split_is_a_partition_with_ceil_per_stratum(spark):
    pdf = make(1001, values=(1.0, 2.0, 5.0))
    pdf.loc[0, "y"] = 9.0  # stratum of size 1 -> its single row is held out (ceil)
    out = stratified_split(spark.createDataFrame(pdf), "y", 0.1, "1", ["k1", "k2"], ["t"], "value").toPandas()
    assert len(out) == len(pdf)
    for y, g in out.groupby("y"):
        assert g.is_test.sum() == math.ceil(0.1 * len(g))
    assert out[out.y == 9.0].is_test.all()


def test_quartile_strata_with_repeated_breaks(spark):
    # 70% of values equal -> several quartile breaks coincide
    pdf = make(1500, values=(4.0,) * 7 + (1.0, 2.0, 5.0))
    got = {(r.k1, r.k2): r.is_test for r in
           stratified_split(spark.createDataFrame(pdf), "y", 0.2, "q", ["k1", "k2"], ["t"], "quartile").collect()}
    assert got == brute_force(pdf, 0.2, "q", "quartile")


def test_close_holdout_and_move_back(spark):
    rows = [(1, 10, 1.0, True), (1, 11, 2.0, False), (2, 10, 3.0, False), (3, 12, 4.0, True),
            (2, 13, 5.0, True), (2, 10, 4.5, True)]
    df = spark.createDataFrame(rows, "u long, m long, r double, is_test boolean")
    ho = split_with_return(df, ["m", "u"])
    hold = sorted(tuple(r) for r in ho.holdout.collect())
    back = sorted(tuple(r) for r in ho.moved_back.collect())
    assert hold == [(1, 10, 1.0), (2, 10, 4.5)]
    assert back == [(2, 13, 5.0), (3, 12, 4.0)]
    assert ho.train.count() == 4
    train = df.filter("not is_test")
    closed = close_holdout(df.filter("is_test"), train, ["m", "u"]).collect()
    assert sorted(tuple(r)[:3] for r in closed) == hold


def test_close_holdout_null_key_matches_null(spark):
    train = spark.createDataFrame([(1, None), (2, "1990")], "u long, y string")
    test = spark.createDataFrame([(1, None), (2, "1991"), (3, "1990")], "u long, y string")
    got = sorted(r.u for r in close_holdout(test, train, ["y"]).collect())
    assert got == [1, 3]


def test_unseen_keys_of_all_kinds_in_one_table(spark):
    rows = [(1, "a", None, False), (2, "a", "1990", False), (1, "b", None, True), (3, "a", "1990", True), (3, "n", "v", True), (None, "b", "", True)]
    df = spark.createDataFrame(rows, "u long, g string, y string, is_test boolean")
    got = {(r.kind, r.key) for r in SP.unseen_keys(df, ["u", "g", "y"]).collect()}
    assert got == {(0, "v3"), (0, "n"), (1, "vb"), (1, "vn"), (2, "vv"), (2, "v")}
    kept = SP.keep_seen(df.where("is_test"), SP.unseen_keys(df, ["u", "y"]), ["u", "y"]).collect()
    assert [(r.u, r.g) for r in kept] == [(1, "b")]


def test_a_stored_hash_gives_the_same_split(spark):
    df = spark.createDataFrame(make(800))
    keys = ["k1", "k2"]
    plain = stratified_split(df, "y", 0.2, "9", keys, ["t"])
    stored = df.withColumn("h", SP.split_hash("9", keys))
    by_column = stored.withColumn("is_test", SP.split_rule(stored, "y", 0.2, tie_keys=["t"], hashed="h"))
    assert sorted(map(tuple, by_column.drop("h").collect())) == sorted(map(tuple, plain.collect()))
