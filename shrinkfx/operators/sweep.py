"""Sweep the regularisation parameter: every alpha of a grid in one set of jobs.

Single-effect models use sufficient statistics. Per key, training gives
``n`` and ``S = sum(r - mu)``; the test rows give ``k``, ``d1 = sum(r - mu)``
and ``d2 = sum((r - mu)^2)``. With ``b = S / (n + alpha)`` the squared error
of the key is ``d2 - 2 b d1 + k b^2``, so the grid multiplies key rows, never
data rows.

A chain of effects touches data rows twice, at any size:

1. The first effect is two numbers per key (n, S), which are joined to the thin
   rows; these are written, and read by all that follows. Rows are dealt by the second key; each task sums one residual per alpha
   and key, so a key's effects come into being where its rows are. Keys that hold
   more than ``hot_share`` of the training rows (fewer than 1 / hot_share) are summed
   map-side instead, and their effects are broadcast.
2. Rows meet the effects of their second key in the same partitioning, and the
   residuals after two effects are summed by the values of each later key, training
   and test rows apart, together with the sum of squares over all test rows.

Later effects need no rows. With R_k = sum of those residuals over the rows of value k,
the stage of key k has ``b_k (n_k + alpha) = R_k - sum_j n(k, j) b_j`` over the values j
of the later keys before it, where n(k, j) counts rows that hold both values (all pairs
are counted in one scan); the same sums over test rows give the change of the squared
error, ``sum_k b_k (m_k b_k - 2 (E_k - sum_j m(k, j) b_j))``.

The grid is cut into blocks of ``WIDTH`` alphas. Whatever is summed per alpha is one row
per block with ``WIDTH`` plain double columns, so the plan, and the time to build it, do
not depend on the grid's length; a row meets the grid by an ``inline`` of its blocks after
the last exchange that data rows cross. The last block is filled up with its last alpha.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shrinkfx.operators.keys import attach, from_key_text, key_text
from shrinkfx.session import materialize

#: A key value is hot when it holds more than this share of the training rows: under 2,000
#: values, whose effects (121 doubles each) are about 2 MB, so they are always broadcast.
HOT_SHARE = 1 / 2000

#: Alphas of a block.
WIDTH = 16


def alpha_grid(spark, lo: float = 0.0, hi: float = 30.0, step: float = 0.25) -> DataFrame:
    """``(alpha)`` for lo, lo+step, ..., hi (integer multiples, no drift)."""
    n = int(round((hi - lo) / step)) + 1
    return spark.range(n).select((F.lit(float(lo)) + F.col("id") * F.lit(float(step))).alias("alpha"))


def grid_values(lo: float = 0.0, hi: float = 30.0, step: float = 0.25) -> list[float]:
    n = int(round((hi - lo) / step)) + 1
    return [lo + i * step for i in range(n)]


def _alphas(alphas: Sequence[float]) -> Column:
    return F.expr("array(" + ", ".join(f"{float(a)!r}D" for a in alphas) + ")")


def sweep_single(train: DataFrame, test: DataFrame, key: str, alphas: Sequence[float],
                 mu: float, rating: str = "rating") -> DataFrame:
    """``(alpha, n, rmse)`` of the model ``mu + b_key(alpha)`` for every alpha.

    Key-level sums are joined once; each *key* row (not data row) is expanded
    per alpha and the squared errors are partially aggregated into one row per
    alpha.
    """
    r = F.col(rating) - F.lit(mu)
    tr = train.groupBy(key).agg(F.count(rating).alias("n"), F.sum(r).alias("s"))
    te = test.groupBy(key).agg(F.count(rating).alias("k"), F.sum(r).alias("d1"),
                               F.sum(r * r).alias("d2"))
    j = attach(te, tr, key, "inner")
    ex = j.select("k", "d1", "d2", "n", "s", F.posexplode(_alphas(alphas)).alias("pos", "alpha"))
    b = F.col("s") / (F.col("n") + F.col("alpha"))
    sse = F.col("d2") - F.lit(2.0) * b * F.col("d1") + F.col("k") * b * b
    return (ex.groupBy("pos", "alpha")
              .agg(F.sum("k").cast("bigint").alias("n"), F.sum(sse).alias("sse"))
              .select("alpha", "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse")))


class Grid:
    """A list of alphas in blocks: SQL texts for the columns of a block."""

    def __init__(self, alphas: Sequence[float]):
        self.alphas = [float(a) for a in alphas]
        filled = self.alphas + [self.alphas[-1]] * (-len(self.alphas) % WIDTH)
        # [{"b": 0, "a0": ..., ...}, ...], one literal once folded
        self.sql = "array(" + ", ".join(
            f"named_struct('b', {i // WIDTH}, " + ", ".join(f"'a{j}', {filled[i + j]!r}D" for j in range(WIDTH)) + ")"
            for i in range(0, len(filled), WIDTH)) + ")"

    def spread(self, df: DataFrame, *columns: str) -> DataFrame:
        """Each row once per block, with the block's number ``b`` and alphas ``a0, a1, ...``."""
        return df.selectExpr(*columns, f"inline({self.sql})")

    def beside(self, df: DataFrame) -> DataFrame:
        """Rows that carry ``b`` with their block as a struct ``g``."""
        return df.selectExpr("*", f"element_at({self.sql}, b + 1) AS g")


def _each(text: str, name: str) -> list[str]:
    """``text AS name`` for every alpha of a block; ``#`` stands for its place there."""
    return [f"{text.replace('#', str(j))} AS {name}{j}" for j in range(WIDTH)]


def _names(name: str) -> list[str]:
    return [f"{name}{j}" for j in range(WIDTH)]


def _sums(rows: DataFrame, by: Sequence[str], count: str, text: str, name: str) -> DataFrame:
    """``(by..., count, name0, ...)``: rows counted and ``text`` summed for every alpha."""
    return rows.groupBy(*by).agg(F.expr(f"count(1) AS {count}"), *map(F.expr, _each(f"sum({text})", name)))


def _effects(sums: DataFrame, grid: Grid) -> DataFrame:
    """``(k, b, n, e0, ...)`` from residual sums ``(k, b, n, r0, ...)``."""
    return grid.beside(sums).selectExpr("k", "b", "n", *_each("r# / (n + g.a#)", "e"))


def _as_array(effects: DataFrame, key: str, kind: str, n_alphas: int) -> DataFrame:
    """``(key, n, eff)`` with the effects of all alphas in one array."""
    whole = effects.selectExpr("k", "n", "b", f"array({', '.join(_names('e'))}) AS e").groupBy("k", "n").agg(
        F.array_sort(F.collect_list(F.struct("b", "e"))).alias("parts"))
    return whole.select(from_key_text("k", kind).alias(key), "n",
                        F.slice(F.flatten("parts.e"), 1, n_alphas).alias("eff"))


class ChainSweep:
    """A chain over training and test rows. What does not depend on alpha (the first key's
    sums, hot second keys, value pairs) is computed once; ``run`` takes any list of alphas."""

    def __init__(self, train: DataFrame, test: DataFrame | None, chain: Sequence[str], mu: float,
                 rating: str = "rating", hot_share: float = HOT_SHARE):
        self.chain, self.kinds = list(chain), dict(train.dtypes)
        self.later = range(2, len(self.chain))

        def thin(df: DataFrame, fit: bool) -> DataFrame:
            return df.where(F.col(rating).isNotNull()).select(
                F.lit(fit).alias("fit"), (F.col(rating) - F.lit(float(mu))).alias("d"),
                *[key_text(k).alias(f"k{s}") for s, k in enumerate(self.chain)])

        rows = thin(train, True)
        rows = rows if test is None else rows.unionByName(thin(test, False))
        self.first = materialize(rows.where("fit").groupBy("k0").agg(
            F.count(F.lit(1)).alias("n"), F.sum("d").alias("s")), f"sweep_{self.chain[0]}")
        self.seen = rows.where("not fit").groupBy("k0").agg(
            F.count(F.lit(1)).alias("m"), F.sum("d").alias("d1"), F.sum(F.col("d") * F.col("d")).alias("d2"))
        if len(self.chain) == 1:
            return
        # written once: where the first effect is too large to broadcast, the join moves every row
        self.rows = materialize(rows.join(self.first.selectExpr("k0", "n AS n0", "s AS s0"), "k0")
                                .withColumnRenamed("k1", "k").drop("k0"), "sweep_rows")
        counts = rows.where("fit").groupBy(F.col("k1").alias("k")).agg(F.count(F.lit(1)).alias("c"))
        total = self.first.agg(F.sum("n")).first()[0] or 0
        self.hot = F.broadcast(materialize(counts.where(F.col("c") > total * hot_share).select("k"), "hot_keys"))
        self.pairs = None
        if len(self.later) > 1:
            pairs = ", ".join(f"named_struct('s', {s}, 'j', {j}, 'key', k{s}, 'other', k{j})"
                              for s in self.later for j in self.later if j < s)
            self.pairs = materialize(self.rows.selectExpr("fit", f"inline(array({pairs}))").groupBy(
                "fit", "s", "j", "key", "other").agg(F.count(F.lit(1)).alias("c")), "sweep_pairs")

    def _second(self, grid: Grid) -> tuple[DataFrame, DataFrame]:
        """(rows with ``effs``, their second key's effects by block; those effects as a table)."""
        residual = "d - s0 / (n0 + a#)"
        packed = F.collect_list(F.struct("b", *_names("e"))).alias("effs")

        def effects(rows: DataFrame) -> DataFrame:
            return _effects(_sums(grid.spread(rows.where("fit"), "k", "d", "n0", "s0"), ["k", "b"], "n", residual, "r"), grid)

        cold_rows = self.rows.join(self.hot, "k", "left_anti").repartition("k")
        hot_rows = self.rows.join(self.hot, "k", "left_semi")
        cold, hot = effects(cold_rows), materialize(effects(hot_rows), "hot_effects")
        met = cold_rows.join(cold.groupBy("k").agg(packed), "k").unionByName(
            hot_rows.join(F.broadcast(hot.groupBy("k").agg(packed)), "k"))
        return met, cold.unionByName(hot)

    def _residuals(self, met: DataFrame, grid: Grid) -> DataFrame:
        """``(fit, kind, key, b, n, r0, ...)``: what rows leave after two effects, summed by each
        value of the later keys (``kind`` is the key's place); of test rows also squared and
        over all of them (kind 1)."""
        keys = [f"k{s}" for s in self.later]
        left = grid.beside(met.selectExpr("fit", "d", "n0", "s0", *keys, "inline(effs)")).selectExpr(
            "fit", "b", *keys, *_each("d - s0 / (n0 + g.a#) - e#", "r"))
        by_key = "".join(f", named_struct('kind', {s}, 'key', k{s})" for s in self.later)
        square = "named_struct('kind', 1, 'key', '')"
        parts = f"if(fit, array({by_key[2:]}), array({square}{by_key}))" if by_key else f"if(fit, array(), array({square}))"
        spread = left.selectExpr("fit", "b", *_names("r"), f"inline({parts})")
        return _sums(spread, ["fit", "kind", "key", "b"], "n", "if(kind = 1, r# * r#, r#)", "r")

    def run(self, alphas: Sequence[float]) -> tuple[list[DataFrame], list[DataFrame]]:
        """(effects per stage as ``(k, b, n, e0, ...)``, squared-error pieces per stage as
        ``(b, m, q0, ...)``, to be summed by ``b``; from the third on they are changes)."""
        grid = Grid(alphas)
        first = grid.spread(self.first, "k0 AS k", "n", "s")
        tables = [first.selectExpr("k", "b", "n", *_each("s / (n + a#)", "e"))]
        beta = "s / (n + a#)"
        pieces = [grid.spread(self.seen.join(self.first, "k0"), "m", "d1", "d2", "n", "s").selectExpr(
            "b", "m", *_each(f"d2 - 2 * ({beta}) * d1 + m * ({beta}) * ({beta})", "q"))]
        if len(self.chain) == 1:
            return tables, pieces
        met, second = self._second(grid)
        tables.append(second)
        sums = materialize(self._residuals(met, grid), "sweep_residuals")
        pieces.append(sums.where("kind = 1").selectExpr("b", "n AS m", *_each("r#", "q")))

        effects: dict[int, DataFrame] = {}
        for s in self.later:
            own = sums.where(F.col("kind") == s).select("fit", "key", "b", "n", *_names("r"))
            if effects:
                known = reduce(DataFrame.unionByName, [t.selectExpr(f"{j} AS j", "k AS other", "b", *_names("e"))
                                                       for j, t in effects.items()])
                met = self.pairs.where(F.col("s") == s).join(known, ["j", "other"])
                taken = met.groupBy("fit", "key", "b").agg(*map(F.expr, _each("sum(c * e#)", "o")))
                own = own.join(taken, ["fit", "key", "b"], "left").selectExpr(
                    "fit", "key", "b", "n", *_each("r# - coalesce(o#, 0D)", "r"))
            own = materialize(own, f"sweep_{self.chain[s]}")
            effects[s] = _effects(own.where("fit").withColumnRenamed("key", "k"), grid)
            tables.append(effects[s])
            ours = own.where("not fit").selectExpr("key AS k", "b", "n AS m", *_names("r"))
            pieces.append(ours.join(effects[s].drop("n"), ["k", "b"]).selectExpr(
                "b", "m", *_each("e# * (m * e# - 2 * r#)", "q")))
        return tables, pieces

    def scores(self, alphas: Sequence[float]) -> DataFrame:
        """``(stage, alpha, n, rmse)`` of every chain prefix."""
        alphas = [float(a) for a in alphas]
        _, pieces = self.run(alphas)
        whole = reduce(DataFrame.unionByName, [p.selectExpr(f"{s} AS part", "*") for s, p in enumerate(pieces, 1)])
        sums = whole.groupBy("part", "b").agg(F.sum("m").alias("n"), *map(F.expr, _each("sum(q#)", "q")))
        each = ", ".join(f"named_struct('pos', {WIDTH} * b + {j}, 'sse', q{j})" for j in range(WIDTH))
        long = sums.selectExpr("part", "n", f"inline(array({each}))").where(F.col("pos") < len(alphas))
        # stages from the third on add their change to the second's error
        stages = F.expr(f"filter(sequence(1, {len(self.chain)}), s -> s = part or (part >= 2 and s > part))")
        out = long.select("part", "pos", "n", "sse", F.explode(stages).alias("stage"))
        return (out.groupBy("stage", "pos").agg(F.max("n").alias("n"), F.sum("sse").alias("sse"))
                .select("stage", F.element_at(_alphas(alphas), F.col("pos") + 1).alias("alpha"), F.col("n").cast("bigint").alias("n"),
                        F.sqrt(F.greatest(F.col("sse"), F.lit(0.0)) / F.col("n")).alias("rmse")))


def fit_chain_arrays(train: DataFrame, chain: Sequence[str], alphas: Sequence[float], mu: float,
                     rating: str = "rating", hot_share: float = HOT_SHARE) -> list[DataFrame]:
    """Per stage: ``(key, n, eff array<double>)`` with one effect per alpha. Rows without a
    rating are left out."""
    tables = ChainSweep(train, None, chain, mu, rating, hot_share).run(alphas)[0]
    kinds = dict(train.dtypes)
    return [_as_array(t, key, kinds[key], len(alphas)) for key, t in zip(chain, tables)]


def sweep_chain(train: DataFrame, test: DataFrame, chain: Sequence[str], alphas: Sequence[float],
                mu: float, rating: str = "rating", hot_share: float = HOT_SHARE) -> DataFrame:
    """``(stage, alpha, n, rmse)``: RMSE of every chain prefix (stage = its length) per alpha.
    Test rows are scored whose keys are known from training, as an inner join would."""
    return ChainSweep(train, test, chain, mu, rating, hot_share).scores(alphas)


def chunks(alphas: Sequence[float], size: int | None) -> list[list[float]]:
    """The grid in runs of ``size`` alphas (all in one without a size)."""
    alphas = [float(a) for a in alphas]
    size = size or len(alphas)
    return [alphas[i:i + size] for i in range(0, len(alphas), size)]


def sweep_chain_batched(train: DataFrame, test: DataFrame, chain: Sequence[str],
                        alphas: Sequence[float], mu: float, batch: int | None = None,
                        rating: str = "rating") -> DataFrame:
    """``sweep_chain`` over the grid in chunks of ``batch`` alphas, which bounds what a run
    spreads rows to; the first effect, hot keys and value pairs are shared by the chunks."""
    sweep = ChainSweep(train, test, chain, mu, rating)
    return reduce(DataFrame.unionByName, [sweep.scores(c) for c in chunks(alphas, batch)])
