"""The model experiment: prepare the splits, sweep ten model families, pick the
best, refit it on all training data and score the validation hold-out.

prepare():
    ratings --stratified 10 % (seed "1")--> held-out / kept
    held-out closed on movie and user  -> validation; the rest moves back -> edx
    edx + features --stratified 20 % (seed "2")--> test / train
    test closed on the five model keys; mu = mean train rating
Every stage that later steps scan more than once is written to the shared
stage folder (``spark.checkpoint.dir``). The source is stored with the two hashes that
order its rows, so they are computed once; edx is stored in two folders, train and test
rows, so ``train`` is read by partition pruning.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shrinkfx.functions.columns import movie_year, rating_week
from shrinkfx.operators.effects import fit, mean_of, predict, rmse
from shrinkfx.operators.split import keep_seen, split_rule, split_with_return, unseen_keys
from shrinkfx.operators.stats import arg_extreme
from shrinkfx.operators.sweep import ChainSweep, chunks, grid_values, sweep_single
from shrinkfx.session import Chunks, path_exists, stage, stage_path
from shrinkfx.sources.testdata import HASH_KEYS, TIE_KEYS, ratings_view

MOVIE, USER, GENRE, YEAR, WEEK = "movie_id", "user_id", "genres", "movie_year", "rating_week"
FULL_CHAIN = [MOVIE, USER, GENRE, YEAR, WEEK]

BACK = "__moved_back"  # stored with edx: held out by the first split, then moved back

# ---- fixed values: model family names, short names, order of the results ----
AVERAGE = "Average"
FAMILIES = [  # (name, short name, effect chain), in the order results are appended
    ("User Effect Model", "UM", [USER]),
    ("Movie Effect Model", "MM", [MOVIE]),
    ("Genre Effect Model", "GM", [GENRE]),
    ("Movie Year Effect Model", "YM", [YEAR]),
    ("Rating Week Effect Model", "RM", [WEEK]),
    ("Movie + User Effect Model", "MUM", [MOVIE, USER]),
    ("Movie + User + Genre Effect Model", "MUGM", [MOVIE, USER, GENRE]),
    ("Movie + User + Genre + Movie Year Effect Model", "MUGYM", [MOVIE, USER, GENRE, YEAR]),
    ("Movie + User + Genre + Movie Year + Rating Week Effect Model", "MUGYRM",
     [MOVIE, USER, GENRE, YEAR, WEEK]),
]
SHORT_NAMES = {AVERAGE: "AM", **{name: short for name, short, _ in FAMILIES}}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    validation_p: float = 0.1
    validation_seed: str = "1"
    test_p: float = 0.2
    test_seed: str = "2"
    strata: str = "quartile"
    grid: tuple = (0.0, 30.0, 0.25)
    mu_from: str = "train"      # "train" (as the script) or "full" (as the report text)
    alpha_batch: int | None = None  # chain sweep: alphas per written piece (None: CHUNK)
    unseen: str = "zero"        # validation scoring: missing effect counts as 0

    @property
    def alphas(self) -> list[float]:
        return grid_values(*self.grid)


@dataclass
class Prepared:
    ratings: DataFrame
    split1: DataFrame
    validation: DataFrame
    moved_back: DataFrame
    edx: DataFrame
    split2: DataFrame
    train: DataFrame
    test_open: DataFrame
    test: DataFrame
    mu: float
    paths: dict = field(default_factory=dict)
    order: tuple = (USER, MOVIE, "ts")  # columns that order rows uniquely, for previews
    n_rejected: int = 0                 # source rows without a rating


def add_features(df: DataFrame) -> DataFrame:
    """+ rating_week (epoch s of the nearest Sunday) and movie_year (text or NULL)."""
    return df.withColumn(WEEK, rating_week("ts")).withColumn(YEAR, movie_year("title"))


_CACHE: dict = {}


def prepare(spark: SparkSession, sf_dir: str, cfg: Config = Config()) -> Prepared:
    """Split stage tables for the driver's test data (the FIXTURES ratings view)."""
    return prepare_ratings(lambda: ratings_view(spark, sf_dir), cfg, HASH_KEYS, TIE_KEYS,
                           cache_key=("view", sf_dir, _files_state(spark, sf_dir)), spark=spark, even=True)


def load_ratings_files(spark: SparkSession, ratings_path: str, movies_path: str) -> DataFrame:
    """Ratings and movies files joined into the rows the experiment needs
    (``user_id, movie_id, rating, ts, title, genres``); every rating is kept
    (left join), the small movies side is joined as AQE sees fit. A movie id on two
    lines, which would multiply its ratings, raises an error when the rows are read
    (``repeated_keys`` lists such ids); movie lines without an id are left out."""
    from shrinkfx.operators.keys import attach, unique_by
    from shrinkfx.sources.dat import read_movies, read_ratings
    return attach(read_ratings(spark, ratings_path), unique_by(read_movies(spark, movies_path), MOVIE), MOVIE, "left")


def _files_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the input tables, so that changed files are prepared anew."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    state = []
    for name in ("lineitem", "orders", "part"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        found = path.getFileSystem(conf).getFileStatus(path)
        state.append((found.getLen(), found.getModificationTime()))
    return tuple(state)


def prepare_ratings(ratings, cfg: Config = Config(), hash_keys=(USER, MOVIE, "ts"), tie_keys=("rating",),
                    cache_key=None, spark: SparkSession | None = None,
                    stage_source: bool = True, even: bool = False) -> Prepared:
    """Build the split stage tables from any ratings DataFrame.

    ``ratings`` (or a zero-argument callable returning it) has ``user_id,
    movie_id, rating, ts, title, genres``; ``hash_keys`` (integer columns) and
    then ``tie_keys`` order rows inside a stratum, so together they should be
    unique per row. With ``cache_key`` the tables are built once per process for
    each configuration and choice of keys. Rows without a rating (malformed lines)
    are left out of the splits and counted in ``n_rejected``. The split scans its
    input a few times, so an expensive source (a join, parsed text) is first
    written as a stage table; pass ``stage_source=False`` when ``ratings`` already
    is a stored columnar table. The written source is rebalanced into files of even size;
    ``even=True`` says that its partitions are even already (it comes out of a shuffle), and
    saves that shuffle of whole rows.

    Written: the source, the tagged hold-out (a tenth), ``edx`` parted into train and test
    rows, and the closed test rows.
    """
    hash_keys, tie_keys = list(hash_keys), list(tie_keys)
    key = None if cache_key is None else (cache_key, cfg.validation_p, cfg.validation_seed, cfg.test_p, cfg.test_seed,
                                          cfg.strata, tuple(hash_keys), tuple(tie_keys), stage_source)
    hit = _CACHE.get(key) if key is not None else None
    if hit and all(path_exists(spark or hit["spark"], p) for p in hit["dirs"].values()):
        return _load(spark or hit["spark"], hit)
    src = ratings() if callable(ratings) else ratings
    spark = spark or src.sparkSession
    dirs: dict[str, str] = {}

    def keep(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        out, dirs[name] = stage(df, name, partition_by)
        return out

    # rebalance: files of even size however the source was laid out
    source = keep(src if even else src.hint("rebalance"), "ratings") if stage_source else src
    rated = source.where(F.col("rating").isNotNull())
    n_rejected = source.where(F.col("rating").isNull()).count()
    first = split_rule(rated, "rating", cfg.validation_p, cfg.validation_seed, hash_keys, tie_keys, cfg.strata)
    split1 = rated.withColumn("is_test", first)
    # tag the held-out rows once; validation and moved-back rows are filters of it
    tagged = keep(add_features(split_with_return(split1, [MOVIE, USER]).tagged), "heldout_tagged")
    kept = split1.filter(~F.col("is_test")).drop("is_test")
    back = tagged.filter(~F.col("known")).drop("known", WEEK, YEAR).withColumn(BACK, F.lit(True))
    rows = add_features(kept.withColumn(BACK, F.lit(False)).unionByName(back))
    second = split_rule(rows, "rating", cfg.test_p, cfg.test_seed, hash_keys, tie_keys, cfg.strata)
    split2 = keep(rows.withColumn("is_test", second), "split2", "is_test")
    # one scan of the stored split finds the values of all five keys that train lacks
    unseen = unseen_keys(split2, FULL_CHAIN)
    keep(keep_seen(split2.filter(F.col("is_test")).drop("is_test", BACK), unseen, FULL_CHAIN), "test")
    hit = {"dirs": dirs, "mu": mean_of(split2.filter(~F.col("is_test"))), "spark": spark,
           "source": None if stage_source else source, "schema": split2.schema,
           "n_rejected": n_rejected, "order": (USER, MOVIE, "ts", *hash_keys, *tie_keys)}
    if key is not None:
        _CACHE[key] = hit
    return _load(spark, hit)


def _load(spark: SparkSession, hit: dict) -> Prepared:
    d = {n: spark.read.parquet(p) for n, p in hit["dirs"].items() if n != "split2"}
    stored = spark.read.schema(hit["schema"]).parquet(hit["dirs"]["split2"])
    split2 = stored.drop(BACK)
    source = d["ratings"] if hit["source"] is None else hit["source"]
    tagged = d["heldout_tagged"]
    # the first split's rows: those kept at once, and the held-out ones
    split1 = (stored.where(~F.col(BACK)).select(*source.columns, F.lit(False).alias("is_test"))
              .unionByName(tagged.select(*source.columns, F.lit(True).alias("is_test"))))
    return Prepared(
        ratings=source, split1=split1,
        validation=tagged.filter(F.col("known")).drop("known"),
        moved_back=tagged.filter(~F.col("known")).drop("known", WEEK, YEAR),
        edx=split2.drop("is_test"), split2=split2,
        train=split2.filter(~F.col("is_test")).drop("is_test"),
        test_open=split2.filter(F.col("is_test")).drop("is_test"),
        test=d["test"], mu=hit["mu"], paths=dict(hit["dirs"]),
        order=tuple(dict.fromkeys(hit["order"])), n_rejected=hit["n_rejected"])


# ---------------------------------------------------------------- models ----

def average_rmse(p: Prepared) -> DataFrame:
    return rmse(p.test.withColumn("pred", F.lit(p.mu)))


def model_rmse(p: Prepared, chain, alpha: float) -> DataFrame:
    """One fitted model scored on the closed test set (inner joins, as in the reference)."""
    m = fit(p.train, chain, alpha, p.mu)
    return rmse(predict(p.test, m, unseen="drop"))


#: alphas in a written piece of the leaderboard
CHUNK = 128


def leaderboard(p: Prepared, alphas=None, cfg: Config = Config(), folder: str | None = None) -> DataFrame:
    """``(ordinal, model, alpha, rmse)`` for the average model and 9 families x grid.

    Results are written in pieces below ``folder`` (the stage folder by default): the average
    model, each single-effect family, and the chains over runs of ``cfg.alpha_batch`` (or
    ``CHUNK``) alphas. Called again with the same folder, prepared splits and grid, pieces
    that were written to the end are read, and only lost ones are computed."""
    alphas = [float(a) for a in (alphas if alphas is not None else cfg.alphas)]
    spark, n_a = p.train.sparkSession, len(alphas)
    folder = folder or stage_path(spark, "leaderboard")
    store = Chunks(spark, folder, {"split": p.paths.get("split2"), "test": p.paths.get("test"), "mu": p.mu,
                                   "alphas": alphas, "batch": cfg.alpha_batch or CHUNK})
    at = F.expr("array(" + ", ".join(f"{a!r}D" for a in alphas) + ")")

    def ordinal(family) -> F.Column:
        return (F.lit(1) + family * n_a + F.array_position(at, F.col("alpha"))).cast("bigint").alias("ordinal")

    def average() -> DataFrame:
        return average_rmse(p).select(F.lit(1).cast("bigint").alias("ordinal"), F.lit(AVERAGE).alias("model"),
                                      F.lit(None).cast("double").alias("alpha"), "rmse")

    def single(i: int, name: str, key: str) -> DataFrame:
        return sweep_single(p.train, p.test, key, alphas, p.mu).select(
            ordinal(F.lit(i)), F.lit(name).alias("model"), "alpha", "rmse")

    sweep: list[ChainSweep] = []

    def chains(part: list[float]) -> DataFrame:
        if not sweep:  # shared by the pieces that have to be computed
            sweep.append(ChainSweep(p.train, p.test, FULL_CHAIN, p.mu))
        scores = sweep[0].scores(part).filter(F.col("stage") >= 2)
        return scores.select(ordinal(family[F.col("stage")]), model[F.col("stage")].alias("model"), "alpha", "rmse")

    chained = [(i, name, len(chain)) for i, (name, _, chain) in enumerate(FAMILIES) if len(chain) > 1]
    model = F.create_map(*[x for _, name, s in chained for x in (F.lit(s), F.lit(name))])
    family = F.create_map(*[x for i, _, s in chained for x in (F.lit(s), F.lit(i))])
    pieces = [store.get("average", average)]
    for i, (name, short, chain) in enumerate(FAMILIES):
        if len(chain) == 1:
            pieces.append(store.get(short, lambda: single(i, name, chain[0])))
    for c, part in enumerate(chunks(alphas, cfg.alpha_batch or CHUNK)):
        pieces.append(store.get(f"chain-{c}", lambda: chains(part)))
    return reduce(DataFrame.unionByName, pieces)


def best(results: DataFrame) -> DataFrame:
    """Lowest RMSE; the first (smallest ordinal) of tied rows."""
    return arg_extreme(results.select("ordinal", "model", "alpha", "rmse"), "rmse", "ordinal")


def chain_of(model_name: str) -> list[str]:
    for name, _, chain in FAMILIES:
        if name == model_name:
            return chain
    return []


def final_validation(p: Prepared, model_name: str, alpha, cfg: Config = Config()) -> DataFrame:
    """Refit the chosen chain on edx with the chosen alpha; score validation."""
    mu = p.mu if cfg.mu_from == "train" else mean_of(p.edx)
    chain = chain_of(model_name)
    if chain:
        m = fit(p.edx, chain, float(alpha), mu)
        scored = predict(p.validation, m, unseen=cfg.unseen)
    else:
        scored = p.validation.withColumn("pred", F.lit(mu)).withColumn("n_unseen", F.lit(0))
    r = scored.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.when(F.col("n_unseen") > 0, 1).otherwise(0)).cast("bigint").alias("n_unseen_rows"),
                   F.sqrt(F.avg(F.pow(F.col("pred") - F.col("rating"), 2))).alias("rmse"))
    return r.select(F.lit(model_name).alias("model"),
                    F.lit(None if alpha is None else float(alpha)).cast("double").alias("alpha"),
                    "n", "n_unseen_rows", "rmse")


def summary(results: DataFrame) -> DataFrame:
    """Per model: best / worst RMSE with their alpha (first on ties) and the mean."""
    is_avg = F.col("model") == F.lit(AVERAGE)
    names = F.create_map(*[F.lit(x) for kv in SHORT_NAMES.items() for x in kv])
    g = results.groupBy("model").agg(
        F.min("rmse").alias("best_rmse"),
        F.min_by("alpha", F.struct("rmse", "ordinal")).alias("best_alpha"),
        F.max("rmse").alias("worst_rmse"),
        F.max_by("alpha", F.struct(F.col("rmse"), -F.col("ordinal"))).alias("worst_alpha"),
        F.avg("rmse").alias("average_rmse"))
    return g.select(
        F.coalesce(names[F.col("model")], F.col("model")).alias("model"),
        "best_rmse", "best_alpha",
        F.when(is_avg, None).otherwise(F.col("worst_rmse")).alias("worst_rmse"),
        "worst_alpha",
        F.when(is_avg, None).otherwise(F.col("average_rmse")).alias("average_rmse"),
    ).orderBy("best_rmse")
