"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the driver's tables through the prepared stage tables (built
once per process) and runs over whole tables. Doubles are rounded to 8
places at the very end so results compare exactly with the DuckDB oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shrinkfx.functions.columns import (format_number_text, movie_year, rating_datetime, rating_month,
                                        rating_week)
from shrinkfx.operators.effects import EffectModel, effect, fit, predict
from shrinkfx.operators.keys import attach, drop_present, keep_known, recode, stack, unique_by
from shrinkfx.operators.stats import year_ticks
from shrinkfx.operators.sweep import sweep_chain, sweep_single
from shrinkfx.plans import experiment as X
from shrinkfx.plans import report as R
from shrinkfx.session import path_exists, stage_path
from shrinkfx.sources.dat import read_movies, read_ratings, write_movies_dat, write_ratings_dat
from shrinkfx.sources.stages import load_stage, save_stage

ALPHA = 5.0
ROW_KEYS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]


def rounded(df: DataFrame, places: int = 8) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def P(spark: SparkSession, sf: str) -> X.Prepared:
    return X.prepare(spark, sf)


# ------------------------------------------------------------ sources ----

def q_read_ratings_dat(spark, sf):
    p = P(spark, sf)
    path = stage_path(spark, "ratings_dat")
    write_ratings_dat(p.ratings, path)
    return read_ratings(spark, path)


def q_read_movies_dat(spark, sf):
    p = P(spark, sf)
    path = stage_path(spark, "movies_dat")
    write_movies_dat(p.ratings.select("movie_id", "title", "genres").distinct(), path)
    return read_movies(spark, path)


def q_stage_roundtrip(spark, sf):
    p = P(spark, sf)
    return load_stage(spark, save_stage(p.train, stage_path(spark, "train_copy")))


def q_enrich_ratings(spark, sf):
    p = P(spark, sf)
    movies = p.ratings.select("movie_id", "title", "genres").distinct()
    r = p.ratings.drop("title", "genres")
    return attach(r, unique_by(movies, "movie_id"), "movie_id", "left")


# ----------------------------------------------------------- features ----

def q_features(spark, sf):
    return X.add_features(P(spark, sf).ratings)


def q_movie_year_feature(spark, sf):
    return P(spark, sf).ratings.select("title", movie_year("title").alias("movie_year")).distinct()


def q_rating_week_feature(spark, sf):
    return P(spark, sf).ratings.select("ts", rating_week("ts").alias("rating_week")).distinct()


def q_rating_month_feature(spark, sf):
    return P(spark, sf).ratings.select("ts", rating_month("ts").alias("rating_month")).distinct()


def q_rating_datetime(spark, sf):
    return P(spark, sf).ratings.select("ts", rating_datetime("ts").alias("rated_at")).distinct()


# -------------------------------------------------------------- split ----

def q_stratified_split_10(spark, sf):
    return P(spark, sf).split1


def q_stratified_split_20(spark, sf):
    return P(spark, sf).split2


def q_semi_known_keys(spark, sf):
    p = P(spark, sf)
    held = p.split1.filter("is_test").drop("is_test")
    kept = p.split1.filter("not is_test").drop("is_test")
    return keep_known(keep_known(held, kept, ["movie_id"]), kept, ["user_id"])


def q_anti_removed_rows(spark, sf):
    p = P(spark, sf)
    held = p.split1.filter("is_test").drop("is_test")
    return drop_present(held, p.validation.drop("rating_week", "movie_year"))


def q_edx_with_moved_back(spark, sf):
    return P(spark, sf).edx


def q_closed_test(spark, sf):
    return P(spark, sf).test


def q_split_profile(spark, sf):
    return R.split_profile(P(spark, sf))


# ------------------------------------------------------------- models ----

def q_global_mean(spark, sf):
    p = P(spark, sf)
    return p.train.agg(F.avg("rating").alias("mu"), F.count(F.lit(1)).alias("n"))


_FITS: dict = {}


def _chain_tables(spark, sf, alpha=ALPHA, src="train"):
    """The five-effect chain at one alpha, fitted once per prepared split."""
    p = P(spark, sf)
    key = (p.paths.get("split2"), alpha, src)
    hit = _FITS.get(key)
    if hit is None or not all(path_exists(spark, f) for f in hit["paths"]):
        m = fit(getattr(p, src), X.FULL_CHAIN, alpha, p.mu)
        hit = _FITS[key] = {"mu": m.mu, "paths": m.paths}
    tables = [spark.read.parquet(f) for f in hit["paths"]]
    return EffectModel(mu=hit["mu"], alpha=alpha, chain=list(X.FULL_CHAIN), tables=tables, paths=hit["paths"])


def _effect_query(key):
    def q(spark, sf):
        m = _chain_tables(spark, sf)
        return m.tables[X.FULL_CHAIN.index(key)]
    q.__name__ = f"q_{key}_effect"
    return q


def q_residual_after_movie(spark, sf):
    p = P(spark, sf)
    t = effect(p.train, "movie_id", F.col("rating") - F.lit(p.mu), ALPHA)
    j = attach(p.train.select(*ROW_KEYS, "movie_id", "rating"),
               t.select("movie_id", F.col("effect").alias("movie_effect")), "movie_id", "inner")
    return j.withColumn("residual", F.col("rating") - F.col("movie_effect") - F.lit(p.mu))


def q_attach_movie_effect(spark, sf):
    p = P(spark, sf)
    t = effect(p.train, "movie_id", F.col("rating") - F.lit(p.mu), ALPHA)
    return attach(p.test.select(*ROW_KEYS, "movie_id", "rating"),
                  t.select("movie_id", F.col("effect").alias("movie_effect")), "movie_id", "inner")


def q_predict_with_unseen(spark, sf):
    p = P(spark, sf)
    m = fit(p.edx, X.FULL_CHAIN, ALPHA, p.mu)
    out = predict(p.validation, m, unseen="zero")
    return out.select(*ROW_KEYS, "rating", "pred", F.col("n_unseen").cast("bigint").alias("n_unseen"))


def q_null_safe_year_join(spark, sf):
    p = P(spark, sf)
    t = effect(p.train, "movie_year", F.col("rating") - F.lit(p.mu), ALPHA)
    j = attach(p.test, t.select("movie_year", F.col("effect").alias("movie_year_effect")),
               "movie_year", "inner")
    return j.groupBy("movie_year").agg(F.count(F.lit(1)).alias("n_test"),
                                       F.first("movie_year_effect").alias("movie_year_effect"))


def q_rmse_average_model(spark, sf):
    p = P(spark, sf)
    return X.average_rmse(p).select(F.lit(X.AVERAGE).alias("model"), "n", "rmse")


def _model_query(fam_idx):
    name, short, chain = X.FAMILIES[fam_idx]

    def q(spark, sf):
        p = P(spark, sf)
        r = X.model_rmse(p, chain, ALPHA)
        return r.select(F.lit(name).alias("model"), F.lit(ALPHA).alias("alpha"), "n", "rmse")
    q.__name__ = f"q_model_{short}"
    return q


def q_sweep_single_effects(spark, sf):
    p = P(spark, sf)
    parts = []
    for name, _, chain in X.FAMILIES:
        if len(chain) == 1:
            s = sweep_single(p.train, p.test, chain[0], X.Config().alphas, p.mu)
            parts.append(s.withColumn("model", F.lit(name)))
    return stack(*parts).select("model", "alpha", "n", "rmse")


def q_sweep_chain(spark, sf):
    p = P(spark, sf)
    alphas = X.Config().alphas
    return sweep_chain(p.train, p.test, X.FULL_CHAIN, alphas, p.mu)


_LB: dict = {}


def _leaderboard(spark, sf):
    """The leaderboard of a prepared split: its written pieces are read, lost ones computed."""
    p = P(spark, sf)
    return X.leaderboard(p, folder=_LB.setdefault((sf, p.paths.get("split2")), stage_path(spark, "leaderboard")))


def q_leaderboard(spark, sf):
    return _leaderboard(spark, sf)


def q_recode_model_names(spark, sf):
    return recode(_leaderboard(spark, sf), "model", X.SHORT_NAMES)


def q_best_model(spark, sf):
    return X.best(_leaderboard(spark, sf))


def q_model_summary(spark, sf):
    return X.summary(_leaderboard(spark, sf))


# ---- fixed values: the printed names of the ten models, in the printed order ----
CATALOG = [
    ("Average Model", X.AVERAGE),
    ("Movie Model", "Movie Effect Model"),
    ("User Model", "User Effect Model"),
    ("Genre Model", "Genre Effect Model"),
    ("Movie Year Model", "Movie Year Effect Model"),
    ("Rating Week Model", "Rating Week Effect Model"),
    ("Movie+User Model", "Movie + User Effect Model"),
    ("Movie+User+Genre Model", "Movie + User + Genre Effect Model"),
    ("Movie+User+Genre+Movie Year Model", "Movie + User + Genre + Movie Year Effect Model"),
    ("Movie+User+Genre+Movie Year+Rating Week Model",
     "Movie + User + Genre + Movie Year + Rating Week Effect Model"),
]
# -----------------------------------------------------------------------------------


def q_model_catalog(spark, sf):
    lb = _leaderboard(spark, sf)
    g = lb.groupBy("model").agg(F.count(F.lit(1)).alias("total_models"),
                                F.min("alpha").alias("lo"), F.max("alpha").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / (F.col("total_models") - 1)
    grid = F.when(F.col("lo").isNull(), F.lit("-")).otherwise(F.concat(
        format_number_text("lo"), F.lit("-"), format_number_text("hi"), F.lit(" ("), format_number_text(step),
        F.lit(" increments)")))
    place = F.array_position(F.array(*[F.lit(m) for _, m in CATALOG]), F.col("model"))
    names = recode(g.withColumn("model_name", F.col("model")), "model_name", {m: n for n, m in CATALOG})
    return names.select(place.alias("position"), "model_name", grid.alias("regularization_parameter"), "total_models")


def q_best_model_line(spark, sf):
    b = X.best(_leaderboard(spark, sf))
    return b.select(R.report_line("Best Model - Training Dataset", [
        ("Model", F.col("model")), ("Alpha", format_number_text("alpha")),
        ("Training RMSE", format_number_text(F.round("rmse", 10)))]).alias("line"))


def q_final_validation_rmse(spark, sf):
    p = P(spark, sf)
    b = X.best(_leaderboard(spark, sf)).first()
    return X.final_validation(p, b["model"], b["alpha"])


def q_final_validation_five_effects(spark, sf):
    return X.final_validation(P(spark, sf), X.FAMILIES[-1][0], ALPHA)


def q_final_result_line(spark, sf):
    r = q_final_validation_rmse(spark, sf)
    return r.select(R.report_line("Best Model - Final Result", [
        ("Model", F.col("model")), ("Alpha", format_number_text("alpha")),
        ("Validation RMSE", format_number_text(F.round("rmse", 10)))]).alias("line"))


# ------------------------------------------------------------- report ----

def _r(fn, *args):
    def q(spark, sf):
        return fn(P(spark, sf), *args)
    q.__name__ = f"q_{fn.__name__}"
    return q


def q_best_worst_movies(spark, sf):
    b, w = R.best_worst(P(spark, sf), "movie_id", 500, "Movie")
    return stack(b, w)


def q_best_worst_genres(spark, sf):
    b, w = R.best_worst(P(spark, sf), "genres", 50, "Genre")
    return stack(b, w)


def q_year_ticks(spark, sf):
    return year_ticks(P(spark, sf).train, "movie_year", 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_ratings_dat": q_read_ratings_dat,
    "read_movies_dat": q_read_movies_dat,
    "stage_roundtrip": q_stage_roundtrip,
    "enrich_ratings": q_enrich_ratings,
    "features": q_features,
    "movie_year_feature": q_movie_year_feature,
    "rating_week_feature": q_rating_week_feature,
    "rating_month_feature": q_rating_month_feature,
    "rating_datetime": q_rating_datetime,
    "stratified_split_10": q_stratified_split_10,
    "stratified_split_20": q_stratified_split_20,
    "semi_known_keys": q_semi_known_keys,
    "anti_removed_rows": q_anti_removed_rows,
    "edx_with_moved_back": q_edx_with_moved_back,
    "closed_test": q_closed_test,
    "split_profile": q_split_profile,
    "global_mean": q_global_mean,
    "movie_effect": _effect_query("movie_id"),
    "user_effect": _effect_query("user_id"),
    "genre_effect": _effect_query("genres"),
    "movie_year_effect": _effect_query("movie_year"),
    "rating_week_effect": _effect_query("rating_week"),
    "residual_after_movie": q_residual_after_movie,
    "attach_movie_effect": q_attach_movie_effect,
    "predict_with_unseen": q_predict_with_unseen,
    "null_safe_year_join": q_null_safe_year_join,
    "rmse_average_model": q_rmse_average_model,
    "model_user": _model_query(0),
    "model_movie": _model_query(1),
    "model_genre": _model_query(2),
    "model_movie_year": _model_query(3),
    "model_rating_week": _model_query(4),
    "model_mu": _model_query(5),
    "model_mug": _model_query(6),
    "model_mugy": _model_query(7),
    "model_mugyw": _model_query(8),
    "sweep_single_effects": q_sweep_single_effects,
    "sweep_chain": q_sweep_chain,
    "leaderboard": q_leaderboard,
    "recode_model_names": q_recode_model_names,
    "best_model": q_best_model,
    "model_summary": q_model_summary,
    "model_catalog": q_model_catalog,
    "best_model_line": q_best_model_line,
    "final_validation_rmse": q_final_validation_rmse,
    "final_validation_five_effects": q_final_validation_five_effects,
    "final_result_line": q_final_result_line,
    "project_train_view": _r(R.train_view),
    "preview_rows": _r(R.train_preview),
    "rating_totals": _r(R.rating_totals),
    "avg_by_movie": _r(R.avg_by, "movie_id"),
    "avg_by_user": _r(R.avg_by, "user_id"),
    "avg_by_genre": _r(R.avg_by, "genres"),
    "avg_by_movie_year": _r(R.avg_by, "movie_year", "year_avg"),
    "avg_by_month": _r(R.avg_by_month),
    "ratings_per_month": _r(R.ratings_per_month),
    "mean_monthly_ratings": _r(R.mean_monthly_ratings),
    "quietest_12_months": _r(R.quietest_months, 12),
    "first_12_months": _r(R.first_months, 12),
    "activity_user": _r(R.activity_of, "user_id"),
    "activity_movie": _r(R.activity_of, "movie_id"),
    "activity_genre": _r(R.activity_of, "genres"),
    "activity_movie_year": _r(R.activity_of, "movie_year"),
    "activity_rating_week": _r(R.activity_of, "rating_week"),
    "activity_all_features": _r(R.activity_all),
    "boxplot_activity": _r(R.boxplot_activity),
    "best_movies": lambda s, sf: R.best_worst(P(s, sf), "movie_id", 500, "Movie")[0],
    "worst_movies": lambda s, sf: R.best_worst(P(s, sf), "movie_id", 500, "Movie")[1],
    "best_worst_movies": q_best_worst_movies,
    "best_genres": lambda s, sf: R.best_worst(P(s, sf), "genres", 50, "Genre")[0],
    "worst_genres": lambda s, sf: R.best_worst(P(s, sf), "genres", 50, "Genre")[1],
    "best_worst_genres": q_best_worst_genres,
    "least_rated_years": _r(R.least_rated_years, 10),
    "user_activity_percentiles": _r(R.user_activity_percentiles),
    "user_activity_shares": _r(R.user_activity_shares),
    "dataset_profile": _r(R.dataset_profile),
    "year_ticks": q_year_ticks,
    "hist_movie_avg": _r(R.hist_of_means, "movie_id"),
    "hist_user_avg": _r(R.hist_of_means, "user_id"),
    "hist_genre_avg": _r(R.hist_of_means, "genres"),
    "kde_movie_avg": _r(R.kde_of_means, "movie_id"),
    "kde_user_avg": _r(R.kde_of_means, "user_id"),
    "kde_genre_avg": _r(R.kde_of_means, "genres"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        return lambda spark, sf: rounded(fn(spark, sf))
    return {k: wrap(v) for k, v in QUERIES.items()}
