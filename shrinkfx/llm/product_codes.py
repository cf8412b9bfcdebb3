"""Product codes by memoised grid cells.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; each part
position has its codebook, refined by rounds of assignment and componentwise floor means.
Nearest entries are found through a grid: a part is hashed to its coarse cell (each
component without its low bits). For a cell met for the first time the least and the
greatest squared distance from its box to every entry are taken; an entry whose least
distance exceeds another's greatest one is dominated everywhere in the box. What is not
dominated is kept in a cache, and a part is compared exactly with its cell's entries only.
Bounds and distances are whole numbers, so no entry is lost and ties go to the lower index.

A round is one scan: each task sums its parts by entry, Spark adds the sums up, and the
new codebooks (``parts * entries`` rows at most) are broadcast. Work and memory of a task
do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.llm import vectors as V
from shrinkfx.llm.frames import arrow_map
from shrinkfx.session import materialize

#: integers beyond this are taken as this: sums of squares of 512 components stay below 2**63
LIMIT = 1 << 26
SALTS = 16


@dataclass(frozen=True)
class Coder:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    #: a cell spans ``2 ** cell_bits`` in every component
    cell_bits: int = 5
    #: cells that a worker keeps for one codebook; the cache is emptied beyond
    max_cells: int = 50_000


def integers(x: np.ndarray, coder: Coder) -> np.ndarray:
    """(rows, parts, width) whole numbers; a length that the parts do not divide is filled
    up with zeros."""
    if len(x) == 0:
        return np.zeros((0, coder.parts, 0), np.int64)
    z = np.clip(np.floor(x * coder.scale), -LIMIT, LIMIT).astype(np.int64)
    z = np.pad(z, ((0, 0), (0, -z.shape[1] % coder.parts)))
    return z.reshape(len(z), coder.parts, -1)


class Cells:
    """The cached cells of one codebook, an integer matrix (entries, width)."""

    def __init__(self, book: np.ndarray, bits: int, max_cells: int):
        self.book, self.bits, self.max_cells = book, bits, max_cells
        self.cache: dict[bytes, np.ndarray] = {}

    def _candidates(self, cells: np.ndarray, step: int = 64) -> Iterator[np.ndarray]:
        """The entries that are nearest somewhere in each cell, as far as the bounds tell."""
        side, width = (1 << self.bits) - 1, self.book.shape[1]
        # in halves of a unit a cell has a whole centre and reaches ``side`` to either side;
        # 32 bits hold all sums unless components are very large
        middle, book = (cells << (self.bits + 1)) + side, 2 * self.book
        top = max(int(np.abs(book).max()), int(np.abs(middle).max(initial=0))) * 2 + side
        kind = np.int32 if top * top * width < 1 << 31 else np.int64
        middle, book = middle.astype(kind), book.astype(kind)
        for at in range(0, len(cells), step):
            off = np.abs(middle[at: at + step, None, :] - book)
            far = np.einsum("ijk,ijk->ij", off, off) + 2 * side * off.sum(2, dtype=kind) + width * side * side
            off -= kind(side)
            np.maximum(off, 0, out=off)
            near = np.einsum("ijk,ijk->ij", off, off)
            for row in near <= far.min(axis=1, keepdims=True):
                yield np.flatnonzero(row)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each row of ``x``."""
        n = len(x)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cells = np.ascontiguousarray(x >> self.bits)
        keys = cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        _, first, cell_of = np.unique(keys, return_index=True, return_inverse=True)
        names = [cells[i].tobytes() for i in first]
        if len(self.cache) > self.max_cells:
            self.cache.clear()
        new = [k for k, name in enumerate(names) if name not in self.cache]
        for k, found in zip(new, self._candidates(cells[first[new]])):
            self.cache[names[k]] = found
        lists = [self.cache[name] for name in names]
        sizes = np.array([len(c) for c in lists])
        starts = np.cumsum(sizes) - sizes
        pool = np.concatenate(lists)
        code, error = np.empty(n, np.int64), np.empty(n, np.int64)
        step = max(1, (1 << 20) // (int(sizes.max()) * x.shape[1]))
        for at in range(0, n, step):
            of = cell_of[at: at + step]
            count = sizes[of]
            begin = np.cumsum(count) - count
            entry = pool[np.repeat(starts[of] - begin, count) + np.arange(count.sum())]
            d = self.book[entry] - np.repeat(x[at: at + step], count, axis=0)
            d = np.einsum("ij,ij->i", d, d)
            least = np.minimum.reduceat(d, begin)
            code[at: at + step] = np.minimum.reduceat(np.where(d == np.repeat(least, count), entry, 1 << 40), begin)
            error[at: at + step] = least
        return code, error


_books: dict[str, list[Cells]] = {}


def _cells(name: str, books: np.ndarray, coder: Coder) -> list[Cells]:
    """The caches for ``books``; a worker keeps those of the newest codebooks from task to task."""
    if name not in _books:
        _books.clear()
        _books[name] = [Cells(b, coder.cell_bits, coder.max_cells) for b in books]
    return _books[name]


def _digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _first_books(rows: DataFrame, coder: Coder) -> np.ndarray | None:
    """Parts of the rows with the smallest ids, ascending: (parts, entries, width)."""
    first = rows.orderBy(F.asc_nulls_last("id"), "vec").limit(coder.entries).collect()
    if not first:
        return None
    return np.ascontiguousarray(integers(np.array([r.vec for r in first], np.float64), coder).transpose(1, 0, 2))


def _refined(rows: DataFrame, books: np.ndarray, coder: Coder) -> np.ndarray:
    """The codebooks after one round. Sums of a task leave as (part, entry, place, n, s)."""
    context = rows.sparkSession.sparkContext
    sent, name = context.broadcast(books), _digest(books)
    parts, entries, width = books.shape
    columns = [(c, pa.int64()) for c in ("slot", "place", "n", "s")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _cells(name, sent.value, coder)
        n, s = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            z = integers(V.matrix(batch.column("vec")), coder)
            for p in range(parts if len(z) else 0):
                code, _ = cells[p].nearest(z[:, p])
                order = np.argsort(code, kind="stable")
                at, begin = np.unique(code[order], return_index=True)
                s[p, at] += np.add.reduceat(z[order, p], begin, axis=0)
                n[p] += np.bincount(code, minlength=entries)
        slot = np.flatnonzero(n.ravel())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(slot, width)), pa.array(np.tile(np.arange(width), len(slot))),
            pa.array(np.repeat(n.ravel()[slot], width)), pa.array(s.reshape(-1, width)[slot].ravel())],
            schema=pa.schema(columns))

    sums = arrow_map(rows.select("vec"), run, "slot long, place long, n long, s long")
    sums = sums.groupBy("slot", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    new = books.reshape(-1, width).copy()
    for r in sums:
        new[r.slot, r.place] = r.s // r.n
    sent.unpersist()
    return new.reshape(books.shape)


def encode(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           coder: Coder = Coder()) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)`` of every row that takes part.

    Left out: rows whose vector is null, empty or holds a null or non-finite component, or
    whose length is not the table's most frequent one (the longest of equally frequent).
    Components beyond 2**26 after scaling are taken as 2**26. Rows that repeat an id are
    coded one by one; a null id comes last in the order that starts the codebooks, rows of
    one id go by their vectors; with fewer rows than entries a codebook has that many.
    ``label_error`` sums ``error`` over the rows of a label, null labels together. Other
    columns are ignored; no rows in, no rows out.
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    rows = rows.where(V.finite(F.col("vec")) & (F.size("vec") > 0))
    rows = rows.where(F.size("vec") == V.usual_length(rows, "vec"))
    spark = table.sparkSession
    id_type, label_type = rows.schema["id"].dataType, rows.schema["label"].dataType
    schema = f"id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error long"
    books = _first_books(rows, coder)
    if books is None:
        return spark.createDataFrame([], f"id {id_type.simpleString()}, code string, error long, "
                                         "label_error long, codebooks_sha256 string")
    for _ in range(coder.rounds):
        books = _refined(rows, books, coder)
    sent, name = spark.sparkContext.broadcast(books), _digest(books)
    digits = 2 if coder.entries <= 256 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _cells(name, sent.value, coder)
        for batch in batches:
            z = integers(V.matrix(batch.column("vec")), coder)
            found = [cells[p].nearest(z[:, p]) for p in range(coder.parts)] if len(z) else []
            error = sum(e for _, e in found) if found else np.zeros(0, np.int64)
            text = ["".join(f"{c:0{digits}x}" for c in row) for row in zip(*(c.tolist() for c, _ in found))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(text, pa.string()),
                                              pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    coded = materialize(arrow_map(rows, run, schema), "codes")
    # a label may hold a third of all rows: its sum meets them in SALTS parts
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    spread = sums.select(F.col("label").alias("_l"), "label_error",
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    joined = salted.join(spread, salted["label"].eqNullSafe(spread["_l"]) & (salted["_salt"] == spread["_s"]))
    return joined.select("id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))
