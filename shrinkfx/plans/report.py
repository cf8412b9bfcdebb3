"""The exploration report: the statistics behind each chart and table.

All queries read the training split (``train``) unless noted; ``mu`` is the
mean training rating. Charts themselves are not drawn -- each function
returns the table a chart is built from. Group-level tables that a statistic
reads twice (a one-row range pass plus the main pass, or a top-n cut plus the
filter) are written once as small stage tables, so ``train`` is aggregated
once per statistic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.functions.columns import percent_label_value, rating_datetime, rating_month
from shrinkfx.operators.keys import stack
from shrinkfx.operators.stats import (activity, activity_sets, box_stats, centred_mean, distinct_counts, group_counts,
                                      histogram, kde, mean_of_counts, percentiles, shares)
from shrinkfx.operators.topn import top_n
from shrinkfx.plans.experiment import GENRE, MOVIE, USER, WEEK, YEAR, Prepared
from shrinkfx.session import materialize

# ---- fixed values: feature labels, class labels and activity thresholds ----
FEATURE_LABELS = [(USER, "User"), (MOVIE, "Movie"), (GENRE, "Genre"),
                  (YEAR, "Movie Year"), (WEEK, "Rating Week")]
USER_SHARE_RULES = [("<= 20", "<=", 20), ("<= 50", "<=", 50), ("< 100", "<", 100)]
# ---------------------------------------------------------------------------


def train_view(p: Prepared) -> DataFrame:
    """Training rows in report column order, with the rating time as a timestamp."""
    return p.train.select(USER, MOVIE, "title", GENRE,
                          rating_datetime("ts").alias("rated_at"), "rating", YEAR, WEEK)


def preview(df: DataFrame, order_by, n: int = 3, n_cols: int | None = None) -> DataFrame:
    """The first ``n`` rows in the order of ``order_by``, cut to the first ``n_cols`` columns."""
    cols = df.columns[:n_cols]
    return df.orderBy(*order_by).limit(n).select(*cols)


def train_preview(p: Prepared, n: int = 3, n_cols: int = 6) -> DataFrame:
    first = [USER, MOVIE, "title", GENRE, "rated_at", "rating"]
    rows = p.train.withColumn("rated_at", rating_datetime("ts"))
    more = [c for c in p.order if c not in first]
    return preview(rows.select(*first, *more), p.order, n, n_cols)


def rating_totals(p: Prepared) -> DataFrame:
    return group_counts(p.train, "rating", "n").withColumn("rating_label", F.col("rating").cast("string"))


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("rating_month", rating_month("ts"))


def avg_by(p: Prepared, key: str, name: str = "average_rating") -> DataFrame:
    return centred_mean(p.train, key, p.mu, name)


def avg_by_month(p: Prepared) -> DataFrame:
    return centred_mean(with_month(p.train), "rating_month", p.mu, "month_avg")


def ratings_per_month(p: Prepared) -> DataFrame:
    return group_counts(with_month(p.train), "rating_month")


def mean_monthly_ratings(p: Prepared) -> DataFrame:
    return mean_of_counts(with_month(p.train), "rating_month")


def quietest_months(p: Prepared, n: int = 12) -> DataFrame:
    t = top_n(materialize(ratings_per_month(p), "ratings_per_month"), -n, "number_ratings")
    return t.withColumn("year_label", F.year(F.date_from_unix_date(
        F.floor(F.col("rating_month") / F.lit(86400.0)).cast("int"))).cast("string"))


def first_months(p: Prepared, n: int = 12) -> DataFrame:
    return ratings_per_month(p).orderBy("rating_month").limit(n)


def activity_of(p: Prepared, key: str) -> DataFrame:
    label = dict(FEATURE_LABELS)[key]
    return activity(p.train, key, label)


def activity_all(p: Prepared) -> DataFrame:
    return activity_sets(p.train, FEATURE_LABELS)


def boxplot_activity(p: Prepared) -> DataFrame:
    return box_stats(materialize(activity_all(p), "activity_all"), "feature", "number_ratings", log10=True)


def best_worst(p: Prepared, key: str, n: int, label: str) -> tuple[DataFrame, DataFrame]:
    # means are compared at 1e-10 so equal means summed in different orders stay tied
    a = materialize(activity(p.train, key).withColumn("average_rating", F.round("average_rating", 10)),
                    f"activity_{key}")
    best = top_n(a, n, "average_rating").withColumn("class", F.lit(f"{n} Best Rated"))
    worst = top_n(a, -n, "average_rating").withColumn("class", F.lit(f"{n} Worst Rated"))
    return best, worst


def least_rated_years(p: Prepared, n: int = 10) -> DataFrame:
    a = materialize(activity(p.train, YEAR), "activity_year")
    return top_n(a, -n, "number_ratings").withColumn("class", F.lit(f"{n} Least Rated Years"))


def user_counts(p: Prepared) -> DataFrame:
    return group_counts(p.train, USER)


def user_activity_percentiles(p: Prepared) -> DataFrame:
    probs = [i / 100.0 for i in range(1, 101)]
    q = percentiles(materialize(user_counts(p), "user_counts"), "number_ratings", probs)
    label = F.concat(F.round(F.col("prob") * 100).cast("int").cast("string"), F.lit("%"))
    return q.select(label.alias("pct_label"), percent_label_value(label).alias("pct"),
                    "value", F.log10("value").alias("log10_value"))


def user_activity_shares(p: Prepared) -> DataFrame:
    return shares(user_counts(p), "number_ratings", USER_SHARE_RULES)


def dataset_profile(p: Prepared, approx: bool = False) -> DataFrame:
    n = distinct_counts(p.ratings, [USER, MOVIE, GENRE, "title", "rating"], F.count(F.lit(1)).alias("n_ratings"),
                        F.sum("rating").alias("sum_rating"), approx=approx)
    return n.select(
        "n_ratings", F.col(f"n_{USER}").alias("n_users"), F.col(f"n_{MOVIE}").alias("n_movies"),
        f"n_{GENRE}", F.col("n_title").alias("n_titles"), F.col("n_rating").alias("n_rating_values"), "sum_rating")


def report_line(header: str, pairs) -> F.Column:
    """The printed result: a header line, then ``label value`` lines, parted by a blank as
    the reference's output is."""
    parts = [F.lit(header + ":\n")]
    for i, (label, value) in enumerate(pairs):
        parts += [F.lit(label + ":"), value] + ([F.lit("\n")] if i + 1 < len(pairs) else [])
    return F.concat_ws(" ", *parts)


def split_profile(p: Prepared) -> DataFrame:
    parts = [("ratings", p.ratings), ("edx", p.edx), ("validation", p.validation),
             ("moved_back", p.moved_back), ("train", p.train), ("test", p.test)]
    return stack(*[d.agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("min_ts"),
                         F.max("ts").alias("max_ts"), F.min("rating").alias("min_rating"),
                         F.max("rating").alias("max_rating"), F.avg("rating").alias("avg_rating"))
                   .withColumn("split", F.lit(name)) for name, d in parts])


def hist_of_means(p: Prepared, key: str) -> DataFrame:
    m = materialize(avg_by(p, key).withColumn("average_rating", F.round("average_rating", 10)), f"means_{key}")
    return histogram(m, "average_rating", 30)


def kde_of_means(p: Prepared, key: str) -> DataFrame:
    # means to 1e-10, so that equal means summed in different orders are one value
    m = materialize(avg_by(p, key).withColumn("average_rating", F.round("average_rating", 10)), f"means_{key}")
    return kde(m, "average_rating", 512)
