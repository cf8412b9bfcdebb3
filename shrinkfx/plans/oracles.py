"""DuckDB oracle SQL for every registered query (same names as ``catalog.QUERIES``)."""

from __future__ import annotations

from shrinkfx.plans import duckdb_sql as D
from shrinkfx.plans.experiment import AVERAGE, FAMILIES, FULL_CHAIN, SHORT_NAMES, Config

ALPHA = 5.0
ROW_KEYS = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity"
GRID = Config().alphas


# What the model table prints, written out: place, printed name, grid text, name in the results.
CATALOG_VALUES = """VALUES
  (1, 'Average Model', '-', 'Average'),
  (2, 'Movie Model', '0-30 (0.25 increments)', 'Movie Effect Model'),
  (3, 'User Model', '0-30 (0.25 increments)', 'User Effect Model'),
  (4, 'Genre Model', '0-30 (0.25 increments)', 'Genre Effect Model'),
  (5, 'Movie Year Model', '0-30 (0.25 increments)', 'Movie Year Effect Model'),
  (6, 'Rating Week Model', '0-30 (0.25 increments)', 'Rating Week Effect Model'),
  (7, 'Movie+User Model', '0-30 (0.25 increments)', 'Movie + User Effect Model'),
  (8, 'Movie+User+Genre Model', '0-30 (0.25 increments)', 'Movie + User + Genre Effect Model'),
  (9, 'Movie+User+Genre+Movie Year Model', '0-30 (0.25 increments)',
   'Movie + User + Genre + Movie Year Effect Model'),
  (10, 'Movie+User+Genre+Movie Year+Rating Week Model', '0-30 (0.25 increments)',
   'Movie + User + Genre + Movie Year + Rating Week Effect Model')"""


def _number(x: str) -> str:
    """A number's shortest text; NA for NULL."""
    return (f"coalesce(regexp_replace(regexp_replace(CAST({x} AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', ''), 'NA')")


def _q(select: str, *ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes if c)
    return D.base_ctes() + extra + "\n" + select


def _one(a: float) -> list:
    return [a]


def _rmse(expr_pred: str = "pred") -> str:
    return f"round(sqrt(avg(power({expr_pred} - rating, 2))), 8)"


def _model_sql(name: str, chain, alpha: float) -> str:
    return _q(f"SELECT '{name}' AS model, {alpha!r}::DOUBLE AS alpha, count(*) AS n, {_rmse()} AS rmse "
              f"FROM ({D.chain_predictions(chain, 'test')})",
              D.chain_ctes(chain, _one(alpha)))


def _effect_sql(key: str) -> str:
    i = FULL_CHAIN.index(key)
    return _q(f"SELECT k AS {key}, n, round(effect, 8) AS effect FROM e{i}",
              D.chain_ctes(FULL_CHAIN, _one(ALPHA)))


def _lb_ctes() -> list[str]:
    """CTEs ``lb(ordinal, model, alpha, rmse)`` -- the whole leaderboard."""
    n_a = len(GRID)
    ctes = []
    parts = [f"SELECT CAST(1 AS BIGINT) AS ordinal, '{AVERAGE}' AS model, CAST(NULL AS DOUBLE) AS alpha, "
             f"sqrt(avg(power(mu - rating, 2))) AS rmse FROM test CROSS JOIN mu"]
    for f, (name, _, chain) in enumerate(FAMILIES):
        if len(chain) == 1:
            pre = f"s{f}_"
            ctes.append(D.chain_ctes(chain, GRID, prefix=pre))
            parts.append(
                f"SELECT CAST(1 + {f * n_a} + idx AS BIGINT) AS ordinal, '{name}' AS model, alpha, "
                f"sqrt(avg(power(pred - rating, 2))) AS rmse "
                f"FROM ({D.chain_predictions(chain, 'test', prefix=pre)}) GROUP BY alpha, idx")
    ctes.append(D.chain_ctes(FULL_CHAIN, GRID, prefix="c"))
    for f, (name, _, chain) in enumerate(FAMILIES):
        if len(chain) > 1:
            parts.append(
                f"SELECT CAST(1 + {f * n_a} + idx AS BIGINT) AS ordinal, '{name}' AS model, alpha, "
                f"sqrt(avg(power(pred - rating, 2))) AS rmse "
                f"FROM ({D.chain_predictions(FULL_CHAIN, 'test', prefix='c', stages=len(chain))}) GROUP BY alpha, idx")
    ctes.append("lb AS (" + "\nUNION ALL\n".join(parts) + ")")
    return ctes


def _lb_sql(select: str) -> str:
    return _q(select, *_lb_ctes())


SHORT_CASE = "CASE model " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SHORT_NAMES.items()) + " ELSE model END"


def _final_sql(select: str = "SELECT f.model, b.alpha, f.n, f.n_unseen_rows, round(f.rmse, 8) AS rmse "
                                "FROM fin f JOIN best b ON f.model = b.model") -> str:
    ctes = _lb_ctes()
    ctes.append("best AS (SELECT model, alpha FROM lb ORDER BY rmse, ordinal LIMIT 1)")
    parts = [f"SELECT '{AVERAGE}' AS model, count(*) AS n, CAST(0 AS BIGINT) AS n_unseen_rows, "
             f"sqrt(avg(power(mu - rating, 2))) AS rmse FROM validation CROSS JOIN mu"]
    for f, (name, _, chain) in enumerate(FAMILIES):
        pre = f"v{f}_"
        ctes.append(D.chain_ctes(chain, src="edx", prefix=pre,
                                 alpha_sql="SELECT alpha, 1 AS idx FROM best WHERE alpha IS NOT NULL"))
        parts.append(
            f"SELECT '{name}' AS model, count(*) AS n, CAST(sum(CASE WHEN n_unseen > 0 THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS n_unseen_rows, sqrt(avg(power(pred - rating, 2))) AS rmse "
            f"FROM ({D.chain_predictions(chain, 'validation', prefix=pre, how='LEFT JOIN', unseen_zero=True)})")
    ctes.append("fin AS (" + "\nUNION ALL\n".join(parts) + ")")
    return _q(select, *ctes)


def _activity(key: str, label: str) -> str:
    return (f"SELECT {key}, count(*) AS number_ratings, round(avg(rating), 8) AS average_rating, "
            f"'{label}' AS feature FROM train GROUP BY {key}")


FEATURES = [("user_id", "User"), ("movie_id", "Movie"), ("genres", "Genre"),
            ("movie_year", "Movie Year"), ("rating_week", "Rating Week")]


def _best_worst(key: str, n: int, which: str) -> str:
    order = "DESC" if which == "best" else "ASC"
    cls = f"{n} Best Rated" if which == "best" else f"{n} Worst Rated"
    return (f"SELECT {key}, number_ratings, round(average_rating, 8) AS average_rating, '{cls}' AS class FROM ("
            f"SELECT *, rank() OVER (ORDER BY average_rating {order}) AS rk FROM ("
            f"SELECT {key}, count(*) AS number_ratings, round(avg(rating), 10) AS average_rating "
            f"FROM train GROUP BY {key})) WHERE rk <= {n}")


def _hist(key: str) -> str:
    return _q(f"""SELECT g.bin, round(s.lo + g.bin * s.w, 8) AS x,
       round(s.lo + (g.bin - 0.5e0) * s.w, 8) AS xmin, round(s.lo + (g.bin + 0.5e0) * s.w, 8) AS xmax,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n, round(coalesce(c.n, 0) / (s.total * s.w), 8) AS density
FROM st s CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range(0, 30)) g
LEFT JOIN cnt c ON c.bin = g.bin""",
              f"m AS (SELECT {key}, round(avg(rating - mu), 10) AS x FROM train CROSS JOIN mu GROUP BY {key})",
              "st0 AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS total FROM m)",
              "st AS (SELECT lo, hi, total, CASE WHEN hi > lo THEN (hi - lo) / 29.0e0 ELSE 1.0e0 END AS w FROM st0)",
              "cnt AS (SELECT greatest(0, CAST(ceil((x - lo) / w - 0.5e0) AS INT)) AS bin, count(*) AS n "
              "FROM m CROSS JOIN st WHERE x IS NOT NULL GROUP BY 1)")


def _kde(key: str) -> str:
    return _q("""SELECT CAST(g.i AS BIGINT) AS i, round(s.lo + g.i * s.step, 8) AS x,
       round(sum(exp(-0.5e0 * power((s.lo + g.i * s.step - m.x) / s.h, 2))) / (s.nn * s.h * sqrt(2 * pi())), 8) AS density
FROM st s CROSS JOIN (SELECT range AS i FROM range(0, 512)) g CROSS JOIN m
GROUP BY g.i, s.lo, s.step, s.nn, s.h""",
              f"m AS (SELECT {key}, round(avg(rating - mu), 10) AS x FROM train CROSS JOIN mu GROUP BY {key})",
              "st0 AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS nn, stddev_samp(x) AS sd, "
              "quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM m)",
              "st AS (SELECT lo, hi, nn, (hi - lo) / 511.0e0 AS step, 0.9e0 * coalesce("
              "CASE WHEN least(sd, iqr / 1.34e0) > 0 THEN least(sd, iqr / 1.34e0) END, "
              "CASE WHEN sd > 0 THEN sd END, 1.0e0) * power(CAST(nn AS DOUBLE), -0.2e0) AS h FROM st0)")


def _split_profile() -> str:
    parts = []
    for name in ["view", "edx", "validation", "moved_back", "train", "test"]:
        label = "ratings" if name == "view" else name
        parts.append(f"SELECT '{label}' AS split, count(*) AS n_rows, min(ts) AS min_ts, max(ts) AS max_ts, "
                     f"min(rating) AS min_rating, max(rating) AS max_rating, round(avg(rating), 8) AS avg_rating "
                     f"FROM {name}")
    return _q("\nUNION ALL\n".join(parts))


def _box() -> str:
    acts = " UNION ALL BY NAME ".join(f"({_activity(k, l)})" for k, l in FEATURES)
    return _q("""SELECT q.feature, q.n, round(least(w.lower_whisker, q.q1), 8) AS lower_whisker, round(q.q1, 8) AS q1,
       round(q.median, 8) AS median, round(q.q3, 8) AS q3, round(greatest(w.upper_whisker, q.q3), 8) AS upper_whisker,
       w.n_outliers
FROM q JOIN (
  SELECT a.feature, min(CASE WHEN y >= lo_f THEN y END) AS lower_whisker,
         max(CASE WHEN y <= hi_f THEN y END) AS upper_whisker,
         CAST(sum(CASE WHEN y >= lo_f AND y <= hi_f THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
  FROM (SELECT feature, log10(number_ratings) AS y FROM acts) a
  JOIN (SELECT feature, q1 - 1.5e0 * (q3 - q1) AS lo_f, q3 + 1.5e0 * (q3 - q1) AS hi_f FROM q) f
    ON a.feature = f.feature
  GROUP BY a.feature) w ON q.feature = w.feature""",
              f"acts AS ({acts})",
              "q AS (SELECT feature, count(*) AS n, quantile_cont(log10(number_ratings), 0.25) AS q1, "
              "quantile_cont(log10(number_ratings), 0.5) AS median, "
              "quantile_cont(log10(number_ratings), 0.75) AS q3 FROM acts GROUP BY feature)")


def _percentiles() -> str:
    probs = ", ".join(f"{i / 100.0!r}" for i in range(1, 101))
    return _q(f"""SELECT CAST(i AS VARCHAR) || '%' AS pct_label, CAST(i AS DOUBLE) AS pct,
       round(qs[i], 8) AS value, round(log10(qs[i]), 8) AS log10_value
FROM (SELECT quantile_cont(number_ratings, [{probs}]) AS qs FROM uc) CROSS JOIN range(1, 101) t(i)""",
              "uc AS (SELECT user_id, count(*) AS number_ratings FROM train GROUP BY user_id)")


def _sweep_single() -> str:
    ctes, parts = [], []
    for f, (name, _, chain) in enumerate(FAMILIES):
        if len(chain) == 1:
            pre = f"s{f}_"
            ctes.append(D.chain_ctes(chain, GRID, prefix=pre))
            parts.append(f"SELECT '{name}' AS model, alpha, count(*) AS n, {_rmse()} AS rmse "
                         f"FROM ({D.chain_predictions(chain, 'test', prefix=pre)}) GROUP BY alpha")
    return _q("\nUNION ALL\n".join(parts), *ctes)


def _sweep_chain() -> str:
    parts = [f"SELECT {s} AS stage, alpha, count(*) AS n, {_rmse()} AS rmse "
             f"FROM ({D.chain_predictions(FULL_CHAIN, 'test', prefix='c', stages=s)}) GROUP BY alpha"
             for s in range(1, len(FULL_CHAIN) + 1)]
    return _q("\nUNION ALL\n".join(parts), D.chain_ctes(FULL_CHAIN, GRID, prefix="c"))


def _summary() -> str:
    return _lb_sql(f"""SELECT {SHORT_CASE} AS model, round(best_rmse, 8) AS best_rmse, best_alpha,
       CASE WHEN model = '{AVERAGE}' THEN NULL ELSE round(worst_rmse, 8) END AS worst_rmse, worst_alpha,
       CASE WHEN model = '{AVERAGE}' THEN NULL ELSE round(average_rmse, 8) END AS average_rmse
FROM (SELECT model, min(rmse) AS best_rmse, max(rmse) AS worst_rmse, avg(rmse) AS average_rmse,
             min(CASE WHEN rb = 1 THEN alpha END) AS best_alpha, min(CASE WHEN rw = 1 THEN alpha END) AS worst_alpha
      FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY rmse, ordinal) AS rb,
                      row_number() OVER (PARTITION BY model ORDER BY rmse DESC, ordinal) AS rw FROM lb)
      GROUP BY model)""")


def _features_union() -> str:
    return " UNION ALL BY NAME ".join(f"({_activity(k, l)})" for k, l in FEATURES)


MONTHS = f"months AS (SELECT {D.MONTH} AS rating_month, rating FROM train)"

ORACLES: dict[str, str] = {
    "read_ratings_dat": _q("SELECT user_id, movie_id, rating, ts FROM view"),
    "read_movies_dat": _q("SELECT DISTINCT movie_id, title, genres FROM view"),
    "stage_roundtrip": _q("SELECT * FROM train"),
    "enrich_ratings": _q("SELECT * FROM view"),
    "features": _q(f"SELECT *, {D.WEEK} AS rating_week, {D.YEAR} AS movie_year FROM view"),
    "movie_year_feature": _q(f"SELECT DISTINCT title, {D.YEAR} AS movie_year FROM view"),
    "rating_week_feature": _q(f"SELECT DISTINCT ts, {D.WEEK} AS rating_week FROM view"),
    "rating_month_feature": _q(f"SELECT DISTINCT ts, {D.MONTH} AS rating_month FROM view"),
    "rating_datetime": _q("SELECT DISTINCT ts, make_timestamp(ts * 1000000) AS rated_at FROM view"),
    "stratified_split_10": _q("SELECT * FROM split1"),
    "stratified_split_20": _q("SELECT * FROM split2"),
    "semi_known_keys": _q("SELECT * FROM validation0"),
    "anti_removed_rows": _q("SELECT * FROM moved_back"),
    "edx_with_moved_back": _q("SELECT * FROM edx"),
    "closed_test": _q("SELECT * FROM test"),
    "split_profile": _split_profile(),
    "global_mean": _q("SELECT round(avg(rating), 8) AS mu, count(*) AS n FROM train"),
    "movie_effect": _effect_sql("movie_id"),
    "user_effect": _effect_sql("user_id"),
    "genre_effect": _effect_sql("genres"),
    "movie_year_effect": _effect_sql("movie_year"),
    "rating_week_effect": _effect_sql("rating_week"),
    "residual_after_movie": _q(
        f"SELECT {ROW_KEYS}, r.movie_id, r.rating, round(e0.effect, 8) AS movie_effect, "
        "round(r.rating - e0.effect - mu.mu, 8) AS residual "
        "FROM train r JOIN e0 ON e0.k = r.movie_id CROSS JOIN mu",
        D.chain_ctes(["movie_id"], _one(ALPHA))),
    "attach_movie_effect": _q(
        f"SELECT {ROW_KEYS}, r.movie_id, r.rating, round(e0.effect, 8) AS movie_effect "
        "FROM test r JOIN e0 ON e0.k = r.movie_id",
        D.chain_ctes(["movie_id"], _one(ALPHA))),
    "predict_with_unseen": _q(
        f"SELECT {ROW_KEYS}, rating, round(pred, 8) AS pred, CAST(n_unseen AS BIGINT) AS n_unseen FROM ("
        + D.chain_predictions(FULL_CHAIN, "validation", how="LEFT JOIN", unseen_zero=True) + ")",
        D.chain_ctes(FULL_CHAIN, _one(ALPHA), src="edx")),
    "null_safe_year_join": _q(
        "SELECT r.movie_year, count(*) AS n_test, round(any_value(e0.effect), 8) AS movie_year_effect "
        "FROM test r JOIN e0 ON e0.k IS NOT DISTINCT FROM r.movie_year GROUP BY r.movie_year",
        D.chain_ctes(["movie_year"], _one(ALPHA))),
    "rmse_average_model": _q(f"SELECT '{AVERAGE}' AS model, count(*) AS n, "
                             "round(sqrt(avg(power(mu - rating, 2))), 8) AS rmse FROM test CROSS JOIN mu"),
    **{f"model_{k}": _model_sql(FAMILIES[i][0], FAMILIES[i][2], ALPHA) for i, k in enumerate(
        ["user", "movie", "genre", "movie_year", "rating_week", "mu", "mug", "mugy", "mugyw"])},
    "sweep_single_effects": _sweep_single(),
    "sweep_chain": _sweep_chain(),
    "leaderboard": _lb_sql("SELECT ordinal, model, alpha, round(rmse, 8) AS rmse FROM lb"),
    "recode_model_names": _lb_sql(f"SELECT ordinal, {SHORT_CASE} AS model, alpha, round(rmse, 8) AS rmse FROM lb"),
    "best_model": _lb_sql("SELECT ordinal, model, alpha, round(rmse, 8) AS rmse FROM lb ORDER BY rmse, ordinal LIMIT 1"),
    "model_summary": _summary(),
    "model_catalog": _lb_sql(
        f"SELECT c.position, c.model_name, c.grid AS regularization_parameter, l.total_models FROM ({CATALOG_VALUES}) c(position, model_name, grid, model) "
        "JOIN (SELECT model, count(*) AS total_models FROM lb GROUP BY model) l ON l.model = c.model"),
    "best_model_line": _lb_sql(
        "SELECT 'Best Model - Training Dataset:' || chr(10) || ' Model: ' || model || ' ' || chr(10) || ' Alpha: ' || "
        f"{_number('alpha')} || ' ' || chr(10) || ' Training RMSE: ' || {_number('round(rmse, 10)')} AS line "
        "FROM (SELECT * FROM lb ORDER BY rmse, ordinal LIMIT 1)"),
    "final_validation_rmse": _final_sql(),
    "final_validation_five_effects": _q(
        "SELECT 'Movie + User + Genre + Movie Year + Rating Week Effect Model' AS model, 5.0::DOUBLE AS alpha, "
        "count(*) AS n, CAST(sum(CASE WHEN n_unseen > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_unseen_rows, "
        f"{_rmse()} AS rmse FROM ("
        + D.chain_predictions(FULL_CHAIN, "validation", how="LEFT JOIN", unseen_zero=True) + ")",
        D.chain_ctes(FULL_CHAIN, _one(ALPHA), src="edx")),
    "final_result_line": _final_sql(
        "SELECT 'Best Model - Final Result:' || chr(10) || ' Model: ' || f.model || ' ' || chr(10) || ' Alpha: ' || "
        f"{_number('b.alpha')} || ' ' || chr(10) || ' Validation RMSE: ' || {_number('round(f.rmse, 10)')} AS line "
        "FROM fin f JOIN best b ON f.model = b.model"),
    "project_train_view": _q("SELECT user_id, movie_id, title, genres, make_timestamp(ts * 1000000) AS rated_at, "
                             "rating, movie_year, rating_week FROM train"),
    "preview_rows": _q("SELECT user_id, movie_id, title, genres, make_timestamp(ts * 1000000) AS rated_at, rating "
                       "FROM train ORDER BY user_id, movie_id, ts, l_orderkey, l_linenumber, l_suppkey, "
                       "l_extendedprice, l_quantity LIMIT 3"),
    "rating_totals": _q("SELECT rating, count(*) AS n, CAST(rating AS VARCHAR) AS rating_label FROM train GROUP BY rating"),
    "avg_by_movie": _q("SELECT movie_id, round(avg(rating - mu), 8) AS average_rating FROM train CROSS JOIN mu GROUP BY movie_id"),
    "avg_by_user": _q("SELECT user_id, round(avg(rating - mu), 8) AS average_rating FROM train CROSS JOIN mu GROUP BY user_id"),
    "avg_by_genre": _q("SELECT genres, round(avg(rating - mu), 8) AS average_rating FROM train CROSS JOIN mu GROUP BY genres"),
    "avg_by_movie_year": _q("SELECT movie_year, round(avg(rating - mu), 8) AS year_avg FROM train CROSS JOIN mu GROUP BY movie_year"),
    "avg_by_month": _q("SELECT rating_month, round(avg(rating - mu), 8) AS month_avg FROM months CROSS JOIN mu GROUP BY rating_month", MONTHS),
    "ratings_per_month": _q("SELECT rating_month, count(*) AS number_ratings FROM months GROUP BY rating_month", MONTHS),
    "mean_monthly_ratings": _q("SELECT round(avg(c), 8) AS mean_number_ratings, count(*) AS n_groups FROM "
                               "(SELECT rating_month, count(*) AS c FROM months GROUP BY rating_month)", MONTHS),
    "quietest_12_months": _q(
        "SELECT rating_month, number_ratings, CAST(year(make_timestamp(rating_month * 1000000)) AS VARCHAR) AS year_label "
        "FROM (SELECT *, rank() OVER (ORDER BY number_ratings) AS rk FROM "
        "(SELECT rating_month, count(*) AS number_ratings FROM months GROUP BY rating_month)) WHERE rk <= 12", MONTHS),
    "first_12_months": _q("SELECT rating_month, count(*) AS number_ratings FROM months GROUP BY rating_month "
                          "ORDER BY rating_month LIMIT 12", MONTHS),
    "activity_user": _q(_activity("user_id", "User")),
    "activity_movie": _q(_activity("movie_id", "Movie")),
    "activity_genre": _q(_activity("genres", "Genre")),
    "activity_movie_year": _q(_activity("movie_year", "Movie Year")),
    "activity_rating_week": _q(_activity("rating_week", "Rating Week")),
    "activity_all_features": _q(_features_union()),
    "boxplot_activity": _box(),
    "best_movies": _q(_best_worst("movie_id", 500, "best")),
    "worst_movies": _q(_best_worst("movie_id", 500, "worst")),
    "best_worst_movies": _q(f"({_best_worst('movie_id', 500, 'best')}) UNION ALL ({_best_worst('movie_id', 500, 'worst')})"),
    "best_genres": _q(_best_worst("genres", 50, "best")),
    "worst_genres": _q(_best_worst("genres", 50, "worst")),
    "best_worst_genres": _q(f"({_best_worst('genres', 50, 'best')}) UNION ALL ({_best_worst('genres', 50, 'worst')})"),
    "least_rated_years": _q(
        "SELECT movie_year, number_ratings, average_rating, '10 Least Rated Years' AS class FROM ("
        "SELECT *, rank() OVER (ORDER BY number_ratings) AS rk FROM ("
        "SELECT movie_year, count(*) AS number_ratings, round(avg(rating), 8) AS average_rating "
        "FROM train GROUP BY movie_year)) WHERE rk <= 10"),
    "user_activity_percentiles": _percentiles(),
    "user_activity_shares": _q(
        "SELECT rule, round(share, 8) AS share FROM (SELECT "
        "avg(CASE WHEN number_ratings <= 20 THEN 1.0e0 ELSE 0.0e0 END) AS s0, "
        "avg(CASE WHEN number_ratings <= 50 THEN 1.0e0 ELSE 0.0e0 END) AS s1, "
        "avg(CASE WHEN number_ratings < 100 THEN 1.0e0 ELSE 0.0e0 END) AS s2 FROM uc) "
        "CROSS JOIN LATERAL (VALUES ('<= 20', s0), ('<= 50', s1), ('< 100', s2)) t(rule, share)",
        "uc AS (SELECT user_id, count(*) AS number_ratings FROM train GROUP BY user_id)"),
    "dataset_profile": _q("SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, "
                          "count(DISTINCT movie_id) AS n_movies, count(DISTINCT genres) AS n_genres, "
                          "count(DISTINCT title) AS n_titles, count(DISTINCT rating) AS n_rating_values, "
                          "round(sum(rating), 8) AS sum_rating FROM view"),
    "year_ticks": _q("SELECT CAST(unnest(range(lo, hi + 1, 10)) AS VARCHAR) AS tick FROM "
                     "(SELECT min(CAST(movie_year AS INT)) AS lo, max(CAST(movie_year AS INT)) AS hi FROM train "
                     "WHERE regexp_full_match(movie_year, '[0-9]{4}'))"),
    "hist_movie_avg": _hist("movie_id"),
    "hist_user_avg": _hist("user_id"),
    "hist_genre_avg": _hist("genres"),
    "kde_movie_avg": _kde("movie_id"),
    "kde_user_avg": _kde("user_id"),
    "kde_genre_avg": _kde("genres"),
}
