"""Nearest neighbours by largest inner product, through stable projections and a kd-tree.

Largest inner product becomes least Euclidean distance: a vector x gets one more component
``sqrt(M**2 - |x|**2)`` (M the largest norm), a query gets 0 there, and the squared
distance is ``M**2 + |q|**2 - 2 q.x``. Gaussian projections to a few dimensions are
2-stable: projected over true squared distance is chi-square distributed with ``dims``
degrees of freedom.

Index: the split planes of a kd-tree over the projections are fitted on a bounded sample;
every row is put into a leaf cell, whose box is taken over all its rows, and cells are
stored in blocks of about ``cell_rows`` rows (a cell of many equal rows has many blocks).

Search: a query meets cells in the order of their boxes' projected distance, in rounds of
1, 4, 16, ... cells. In a block, rows are verified (true inner product) in the order of
their projected distance r, until the stopping test holds: with D the k-th best squared
distance, a row nearer than D that has not been met has a projected distance above r, with
a chance of at most ``1 - chi2(r**2 / D)``; the search ends when that is under
``1 - confidence``. The same test ends a query's rounds, on the next cell's box.

Queries are shipped packed by cell and joined with the blocks of the cell; the tree, its
boxes and the projection (at most ``max_cells`` rows) are all that is broadcast. Each round
is written to the shared folder. A worker holds one Arrow batch of joined blocks, which
Spark bounds in bytes (``spark.sql.execution.arrow.maxBytesPerBatch``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shrinkfx.llm import vectors as V
from shrinkfx.llm.frames import arrow_map
from shrinkfx.session import materialize


@dataclass(frozen=True)
class Search:
    dims: int = 10             # even, for the closed form of the chi-square distribution
    confidence: float = 0.99
    cell_rows: int = 4096
    max_cells: int = 1 << 16
    #: rows (by hash of the id) on which the split planes are fitted; all rows are indexed
    sample: int = 1 << 16
    query_rows: int = 256      # queries in one packed row
    seed: int = 11


def chi2_cdf(x: float, dims: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi2_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, dims) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dims) < p else (low, mid)
    return high


def _projection(length: int, s: Search) -> np.ndarray:
    return np.random.default_rng(s.seed).standard_normal((length + 1, s.dims))


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that makes all norms equal to the largest, ``top ** 0.5``."""
    return np.hstack([x, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))[:, None]])


def in_order(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``x`` with ``q``, summed from the first component to
    the last, so that equal vectors have equal scores wherever they stand."""
    return np.add.accumulate(x * q, axis=1)[:, -1]


class Tree:
    """Split planes of a balanced kd-tree, level by level; leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        groups = [sample]
        while len(groups) * 2 <= leaves:
            dim, at, split = [], [], []
            for g in groups:
                d = int(np.argmax(np.ptp(g, axis=0))) if len(g) else 0
                v = float(np.median(g[:, d])) if len(g) else 0.0
                right = g[:, d] > v
                dim.append(d)
                at.append(v)
                split += [g[~right], g[right]]
            self.levels.append((np.array(dim), np.array(at)))
            groups = split

    def leaf(self, p: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(p), np.int64), np.arange(len(p))
        for dim, at in self.levels:
            node = 2 * node + (p[rows, dim[node]] > at[node])
        return node


def _clean(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, one per id."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(F.col("id").isNotNull())
    rows = rows.where(V.finite(F.col("vec")) & F.exists("vec", lambda v: v != 0))
    rows = rows.where(F.size("vec") == V.usual_length(rows, "vec"))
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    return rows.join(repeated, "id", "left_anti").unionByName(
        rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("vec").alias("vec")))


def _far(boxes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared distances (rows of p, boxes); boxes are (2, cells, dims)."""
    out = np.empty((len(p), boxes.shape[1]))
    step = max(1, (1 << 21) // boxes[0].size)
    for i in range(0, len(p), step):
        part = p[i: i + step, None, :]
        away = np.maximum(np.maximum(boxes[0] - part, part - boxes[1]), 0)
        out[i: i + step] = np.einsum("ijk,ijk->ij", away, away)
    return out


def _index(rows: DataFrame, top: float, a: np.ndarray, n: int, s: Search) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(blocks: cell, block, ids, vecs; cell numbers; their boxes)."""
    context = rows.sparkSession.sparkContext
    matrix = context.broadcast(a)
    leaves = min(s.max_cells, max(1, n // s.cell_rows))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = V.matrix(batch.column("vec"))
            p = _lifted(x, top) @ matrix.value if len(x) else np.zeros((0, s.dims))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(p), pa.list_(pa.float64()))],
                                             names=["id", "p"])

    fitted = rows.orderBy(F.xxhash64("id"), "id").limit(s.sample)
    kind = rows.schema["id"].dataType.simpleString()
    sample = np.array([r.p for r in arrow_map(fitted, project, f"id {kind}, p array<double>").collect()])
    tree = context.broadcast(Tree(sample, leaves))
    edges = ", ".join(f"p{j} double" for j in range(s.dims))
    vec_kind = rows.schema["vec"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = V.matrix(batch.column("vec"))
            if len(x) == 0:
                continue
            p = _lifted(x, top) @ matrix.value
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vec"), pa.array(tree.value.leaf(p)), *map(pa.array, p.T.copy())],
                names=["id", "vec", "cell", *[f"p{j}" for j in range(s.dims)]])

    placed = materialize(arrow_map(rows, place, f"id {kind}, vec {vec_kind}, cell long, {edges}"), "placed")
    measures = [f(f"p{j}").alias(f"{w}{j}") for w, f in (("lo", F.min), ("hi", F.max)) for j in range(s.dims)]
    found = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *measures).orderBy("cell").collect()
    cells = np.array([r.cell for r in found])
    boxes = np.array([[[r[f"{w}{j}"] for j in range(s.dims)] for r in found] for w in ("lo", "hi")])
    count = rows.sparkSession.createDataFrame(
        [(int(r.cell), -(-r.n // s.cell_rows)) for r in found], "cell long, n_blocks long")
    block = F.pmod(F.xxhash64("id"), F.col("n_blocks")).alias("block")
    blocks = (placed.join(F.broadcast(count), "cell").groupBy("cell", block)
              .agg(F.collect_list(F.struct("id", "vec")).alias("rows"))
              .select("cell", "block", F.col("rows.id").alias("ids"), F.flatten("rows.vec").alias("vecs")))
    return materialize(blocks, "blocks"), cells, boxes


def search(table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           s: Search = Search()) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` rows found with the largest inner product
    for each row that meets ``is_query`` (a condition on the column ``id``), itself left out.

    Scores are inner products of the vectors as given, in double precision, summed in the
    order of the components; equal scores go by the smaller id. Left out on both sides: rows
    without id, vectors that are null, empty, zero, hold a null or non-finite component, or
    are not of the table's most frequent length (the longest of equally frequent ones). Rows
    that share an id are one, with the smallest of their vectors. With no other row a query
    has no result. Other columns are ignored.
    """
    spark = table.sparkSession
    rows = _clean(table, id_col, vec_col)
    norm = F.aggregate("vec", F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double"))
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top"), F.max(F.size("vec")).alias("length"),
                     F.count(F.when(is_query, 1)).alias("queries")).first()
    kind, vec_kind = rows.schema["id"].dataType.simpleString(), rows.schema["vec"].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score double")
    if not about.queries or about.n < 2:
        return empty
    top, quantile = float(about.top), chi2_quantile(s.confidence, s.dims)
    a = _projection(about.length, s)
    blocks, cells, boxes = _index(rows, top, a, about.n, s)
    sent = spark.sparkContext.broadcast((cells, boxes, a))
    arrow_ids = pa.schema([("id", {"int": pa.int32()}.get(kind, pa.int64()))]).field("id").type

    def visits(first: int, last: int):
        """Pack the queries of a batch by the cells they meet as the ``first``-th to the
        ``last``-th, nearest box first, as long as the stopping test does not hold."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, boxes, a = sent.value
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    batch = whole.slice(at, 1024)
                    q = V.matrix(batch.column("vec"))
                    far = _far(boxes, np.hstack([q, np.zeros((len(q), 1))]) @ a)
                    order = np.argsort(far, axis=1, kind="stable")[:, first:last]
                    kth = np.asarray(batch.column("kth"), np.float64)
                    bound = quantile * (top + np.einsum("ij,ij->i", q, q) - 2 * kth)
                    at_q, at_c = np.nonzero(np.take_along_axis(far, order, 1) < bound[:, None])
                    met = order[at_q, at_c]
                    by_cell = np.argsort(met, kind="stable")
                    at_q, met = at_q[by_cell], met[by_cell]
                    edges = np.flatnonzero(np.diff(met, prepend=-1))
                    for i, j in zip(edges, [*edges[1:], len(met)]):
                        for b in range(i, j, s.query_rows):
                            own = pa.array(at_q[b: min(j, b + s.query_rows)])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([cells[met[i]]], pa.int64()), pa.array([batch.column("id").take(own).to_pylist()], pa.list_(arrow_ids)),
                                 pa.array([kth[own.to_numpy()]], pa.list_(pa.float64())), pa.array([q[own.to_numpy()].ravel()], pa.list_(pa.float64()))],
                                names=["cell", "q_ids", "kth", "q_vecs"])
        return run

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value[2]
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, ids = batch.column("q_ids")[i].as_py(), np.asarray(batch.column("ids")[i].values)
                x = np.asarray(batch.column("vecs")[i].values, np.float64).reshape(len(ids), -1)
                q = np.asarray(batch.column("q_vecs")[i].values).reshape(len(q_ids), -1)
                kth = np.asarray(batch.column("kth")[i].values)
                p, pq = _lifted(x, top) @ a, q @ a[:-1]
                r = np.einsum("ij,ij->i", pq, pq)[:, None] + np.einsum("ij,ij->i", p, p) - 2 * pq @ p.T
                out = [_nearest(x, ids, q[j], q_ids[j], r[j], kth[j], k, top, quantile) for j in range(len(q_ids))]
                sizes = [len(o[0]) for o in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, sizes), arrow_ids), pa.array(np.concatenate([o[0] for o in out]), arrow_ids),
                     pa.array(np.concatenate([o[1] for o in out]))], names=["q", "id", "score"])

    # queries of one cell together, so that their visits pack well; kth: their k-th score so far
    near = F.lit(float("-inf"))
    queries = materialize(blocks.select("cell", F.inline(F.arrays_zip(
        F.col("ids").alias("id"), F.transform(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.slice(
            "vecs", i * about.length + 1, about.length)).alias("vec")))).where(is_query).select("id", "vec"), "queries")
    state = queries.withColumn("kth", near)
    best, first, last = None, 0, 1
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    while first < len(cells):
        packed = arrow_map(state, visits(first, last), f"cell long, q_ids array<{kind}>, kth array<double>, q_vecs array<double>")
        met = arrow_map(packed.join(blocks.select("cell", "ids", "vecs"), "cell"), verify, f"q {kind}, id {kind}, score double")
        ranked = (met if best is None else met.unionByName(best)).withColumn("rank", F.row_number().over(by_score))
        kept = materialize(ranked.where(F.col("rank") <= k), "nearest")
        best, first, last = kept.drop("rank"), last, last + 4 * (last - first)
        bound = kept.where(F.col("rank") == k).select(F.col("q").alias("id"), F.col("score").alias("kth"))
        state = queries.join(bound, "id", "left").withColumn("kth", F.coalesce("kth", near))
    return kept.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), "id", "score")


def _nearest(x, ids, q, q_id, r, kth, k, top, quantile):
    """(ids, scores) of a block's rows that may be among the query's ``k`` best. Rows are
    verified in the order of their projected distances ``r`` until the test holds."""
    norm = top + float(q @ q)
    limit = quantile * (norm - 2 * kth)
    near = np.flatnonzero((r < limit) & (ids != q_id))
    near = near[np.argsort(r[near], kind="stable")]
    seen, scores, step = 0, np.zeros(0), 4 * k
    while seen < len(near) and r[near[seen]] < limit:
        part = near[seen: seen + step]
        scores = np.concatenate([scores, x[part] @ q])
        seen, step = seen + len(part), 2 * step
        if len(scores) >= k:
            kth = max(kth, float(np.partition(scores, -k)[-k]))
            limit = quantile * (norm - 2 * kth)
    # products summed in another order may differ in the last places: a margin, then exact order
    keep = near[:seen][scores >= kth - 1e-9 * norm]
    exact = in_order(x[keep], q)
    first = np.lexsort((ids[keep], -exact))[:k]
    return ids[keep][first], exact[first]
