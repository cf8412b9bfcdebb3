"""Removal of repeated passages by content-defined hash grouping in rounds.

This takes the place of the dealt method and is not it: no Burrows-Wheeler transform,
suffix order, interleave vector or common-prefix array is built, windows are anchored by
their least gram hash and hashes are grouped by key. What is kept of the merge of shard
transforms by iterative interleave refinement is its shape: suffixes of all shards stand in blocks of equal first symbols, a round
splits blocks by one more symbol, blocks of one suffix are settled and leave, and what
still shares a block at the end is a repeated interval with a known common prefix. No
shard's suffixes are sorted again; a round only merges the shards' intervals.

Two changes fit it to a cluster. First, the transform is taken over a content-defined
parse, not over bytes, so that a match of ``length`` bytes needs four rounds instead of
``length``: every window of ``length`` bytes is anchored at the place of its least
``gram``-byte hash, and a run of windows with one anchor is one suffix of the parse.
Second, symbols are hashes, so an interval is a key, and merging the shards' intervals is
an aggregate over (key, shard) rows:

1. first symbol: the gram at the anchor. Grams held once are settled.
2. the symbols to the right and left (the transform's own symbol): the bytes of the whole
   run. Equal runs repeat as a whole: all but the first are removed. Runs alone in their
   block are settled.
3. where a block still holds different runs, the same for sub-runs of ``PART`` windows of
   their first ones; all windows of a sub-run share all but a few bytes.
4. where that still leaves different ones, single windows.

Each round reads the shards anew (a copy with shard numbers in the shared folder), sends
one row per interval and shard, and hands back to each shard only its open intervals, as
a table partitioned by shard. A passage that a third of all documents hold is one row per
shard. Texts are never shuffled.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shrinkfx.llm import textkit as K
from shrinkfx.llm.frames import arrow_map
from shrinkfx.session import drop_table, stage, stage_path

GRAM = 50
CHUNK = 1 << 21
FOLD_ROWS = 1 << 21
_NO_ID = -(1 << 63)


@dataclass
class Runs:
    """Runs of windows with one anchor; places count from the slice's start."""

    row: np.ndarray
    anchor: np.ndarray
    low: np.ndarray  # first window of the run
    high: np.ndarray  # last window
    gram: np.ndarray
    whole: np.ndarray  # hash of the run's bytes and of the anchor's place in it

    def pick(self, where: np.ndarray) -> "Runs":
        return Runs(*(getattr(self, f)[where] for f in ("row", "anchor", "low", "high", "gram", "whole")))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs_of(data: np.ndarray, offs: np.ndarray, prefix: np.ndarray, length: int, gram: int) -> Iterator[Runs]:
    """The runs of all windows of a slice, in pieces of about ``CHUNK`` windows. A window
    belongs to one row; its anchor and place depend on its own bytes alone."""
    low_bits = np.uint64((1 << 24) - 1)
    for at in range(0, len(data) - length + 1, CHUNK):
        n = min(CHUNK, len(data) - length + 1 - at)
        grams = np.arange(at, at + n + length - gram)
        value = (K.span_hash(prefix, grams, grams + gram) & ~low_bits) | (grams - at).astype(np.uint64)
        anchor = (_least(value, length - gram + 1) & low_bits).astype(np.int64) + at
        start = np.arange(at, at + n)
        row = np.searchsorted(offs, start, "right") - 1
        inside = start + length <= offs[row + 1]
        start, anchor, row = start[inside], anchor[inside], row[inside]
        if len(start) == 0:
            continue
        new = np.flatnonzero(np.concatenate(
            [[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
        last = np.append(new[1:], len(start)) - 1
        low, high, anchor = start[new], start[last], anchor[new]
        whole = K.span_hash(prefix, low, high + length) + K.mix((anchor - low).astype(np.uint64))
        yield Runs(row[new], anchor, low, high, K.span_hash(prefix, anchor, anchor + gram), whole)


def _pieces(batches: Iterator[pa.RecordBatch]):
    """(shard, ids, offsets, bytes, prefix hash, slice) of runs of rows of one shard."""
    for batch in batches:
        for part in K.slices(batch, "text"):
            shards = np.asarray(part.column("shard"))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                piece = part.slice(a, b - a)
                data, offs = K.flat(piece.column("text"))
                ids = np.asarray(piece.column("id").fill_null(_NO_ID))
                yield int(shards[a]), ids, offs, data, K.prefix_hash(data), piece


class _Intervals:
    """Rows (shard, keys..., id, place) folded to one per shard and key: count and first."""

    def __init__(self, keys: int, types: pa.Schema):
        self.keys, self.types, self.parts, self.size = keys, types, [], 0

    def add(self, shard: int, keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> None:
        self.parts.append((np.full(len(doc), shard), *keys, doc, place))
        self.size += len(doc)

    def fold(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        cols = [np.concatenate(x) for x in zip(*self.parts)]
        self.parts, self.size = [], 0
        # the last key decides alone, but for collisions, which the comparison below tells apart
        order = np.lexsort((cols[-1], cols[-2], cols[0], cols[self.keys]))
        cols = [c[order] for c in cols]
        new = np.zeros(len(order), bool)
        new[0] = True
        for c in cols[: self.keys + 1]:
            new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(order)))
        out = [c[first].view(np.int64) if c.dtype == np.uint64 else c[first] for c in cols] + [counts]
        for i in range(0, len(first), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[i: i + (1 << 16)]).cast(t.type) for c, t in zip(out, self.types)], schema=self.types)


def _rows(copy: DataFrame, keys: tuple[str, ...], emit: Callable) -> DataFrame:
    """(shard, keys..., id, place, n): what ``emit(piece..., add)`` adds, folded in tasks."""
    types = pa.schema([("shard", pa.int32()), *((k, pa.int64()) for k in keys), ("id", pa.int64()),
                       ("place", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Intervals(len(keys), types)
        for shard, ids, offs, data, prefix, _ in _pieces(batches):
            emit(shard, ids, offs, data, prefix, held.add)
            if held.size > FOLD_ROWS:
                yield from held.fold()
        yield from held.fold()

    return arrow_map(copy, run, "shard int, " + ", ".join(f"{k} long" for k in keys) + ", id long, place long, n long")


def _handed_back(rows: DataFrame, name: str) -> str:
    """Write ``rows`` by shard; tasks read their shard's folder."""
    path = stage_path(rows.sparkSession, name)
    rows.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
    return path


class _Shards:
    """The table of one shard at a time, sorted by ``key``."""

    def __init__(self, path: str, key: str):
        self.path, self.key, self.shard, self.table = path, key, None, {}

    def of(self, shard: int) -> dict[str, np.ndarray]:
        if shard != self.shard:
            fs, path = pafs.FileSystem.from_uri(self.path)
            folder = f"{path}/shard={shard}"
            cols: dict[str, np.ndarray] = {}
            if fs.get_file_info(folder).type == pafs.FileType.Directory:
                got = pq.read_table(folder, filesystem=fs, partitioning=None)
                cols = {c: np.asarray(got.column(c).combine_chunks()) for c in got.column_names}
                order = np.argsort(cols[self.key].view(np.uint64))
                cols = {c: v[order] for c, v in cols.items()}
            self.shard, self.table = shard, cols
        return self.table

    def find(self, shard: int, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        table = self.of(shard)
        if not table or len(keys) == 0:
            return np.full(len(keys), -1, np.int64)
        sorted_keys = table[self.key].view(np.uint64)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return np.where(sorted_keys[at] == keys, at, -1)


def _windows(r: Runs) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run, start) of every window of the runs."""
    n = r.high - r.low + 1
    run = K.row_of(n)
    return run, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + r.low[run]


def _first(found: np.ndarray, table: dict, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each place is the first one of its interval (of those that are found)."""
    return (table["first_id"][found] == doc) & (table["first_place"][found] == place)


PART = 8


def _sub_runs(r: Runs, prefix: np.ndarray, length: int) -> Runs:
    """Runs cut at distances from the anchor that are multiples of ``PART``. The symbol of a
    sub-run is what all windows of its distances share, ``length - PART + 1`` bytes."""
    near, far = (r.anchor - r.high) // PART, (r.anchor - r.low) // PART
    n = far - near + 1
    run = K.row_of(n)
    q = near[run] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    anchor = r.anchor[run]
    right = anchor - q * PART
    low, high = np.maximum(r.low[run], right - PART + 1), np.minimum(r.high[run], right)
    core = K.span_hash(prefix, right, right - PART + 1 + length) + K.mix(q.astype(np.uint64))
    whole = K.span_hash(prefix, low, high + length) + K.mix((anchor - low).astype(np.uint64))
    return Runs(r.row[run], anchor, low, high, core, whole)


def repeated_spans(docs: DataFrame, length: int = 100, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept) of every row: the maximal byte runs [start, end) covered
    by strings of ``length`` bytes that also start earlier (in a smaller id or before in
    the same row), and the remaining bytes joined.

    Null text is empty; texts shorter than ``length`` keep everything. Matches stay inside
    a row and are judged on the input. A null id comes before all others. Rows with equal
    ids are one document read again: the same place in them is no earlier place. Other
    columns are ignored; no rows in, no rows out."""
    spark, path = docs.sparkSession, stage_path(docs.sparkSession, "shards")
    docs.select(F.spark_partition_id().alias("shard"), F.col(id_col).cast("long").alias("id"),
                F.coalesce(F.col(text_col), F.lit("")).alias("text")).write.option("compression", "zstd").parquet(path)
    copy = spark.read.parquet(path)

    def found_runs(shard, ids, offs, data, prefix, tables) -> Iterator[tuple[list[Runs], Runs]]:
        """For each piece of a slice: (runs and sub-runs that repeat earlier ones, those that are
        first in a mixed block of the last table), going down as many levels as tables are known."""
        for r in runs_of(data, offs, prefix, length, gram):
            later = []
            for level, table in enumerate(tables):
                if level == 1:
                    r = _sub_runs(r, prefix, length)
                found = table.find(shard, r.whole)
                r, found = r.pick(found >= 0), found[found >= 0]
                if len(found):
                    first = _first(found, table.of(shard), ids[r.row], r.low - offs[r.row])
                    later.append(r.pick(~first))
                    r = r.pick(first & table.of(shard)["mixed"][found])
            yield later, r

    def grams(shard, ids, offs, data, prefix, add) -> None:
        for r in runs_of(data, offs, prefix, length, gram):
            add(shard, [r.gram], ids[r.row], r.anchor)

    def wholes(shard, ids, offs, data, prefix, add, table=None) -> None:
        for r in runs_of(data, offs, prefix, length, gram):
            r = r.pick(table.find(shard, r.gram) >= 0)
            add(shard, [r.gram, r.whole], ids[r.row], r.low - offs[r.row])

    def parts(shard, ids, offs, data, prefix, add, tables=()) -> None:
        for _, r in found_runs(shard, ids, offs, data, prefix, tables):
            r = _sub_runs(r, prefix, length)
            add(shard, [r.gram, r.whole], ids[r.row], r.low - offs[r.row])

    def windows(shard, ids, offs, data, prefix, add, tables=()) -> None:
        for _, r in found_runs(shard, ids, offs, data, prefix, tables):
            run, start = _windows(r)
            add(shard, [r.gram[run], K.span_hash(prefix, start, start + length)],
                ids[r.row[run]], start - offs[r.row[run]])

    def open_grams() -> str:
        rows = _rows(copy, ("gram",), grams).select("shard", "gram", "n")
        total = rows.withColumn("total", F.sum("n").over(W.partitionBy("gram")))
        return _handed_back(total.where("total > 1").select("shard", "gram"), "open-grams")

    def open_runs(emit: Callable, name: str) -> str:
        """The runs of open blocks: first place, and whether the block holds different runs."""
        keys = ["gram", "whole"]
        rows, intervals = stage(_rows(copy, ("gram", "whole"), emit), f"{name}-intervals")
        blocks = rows.groupBy(*keys).agg(F.min(F.struct("id", "place")).alias("first"), F.sum("n").alias("n"))
        # least and greatest are combined map-side: a gram with many runs is one row per task
        mixed = rows.groupBy("gram").agg((F.min("whole") < F.max("whole")).alias("mixed"))
        state = blocks.join(mixed, "gram").where("n > 1 or mixed").select(
            *keys, F.col("first.id").alias("first_id"), F.col("first.place").alias("first_place"), "mixed")
        table = _handed_back(rows.join(state, keys).select(
            "shard", "whole", "first_id", "first_place", "mixed"), name)
        drop_table(spark, intervals)  # what is handed back is all that later rounds read
        return table

    def open_windows(emit: Callable) -> str:
        # a window is one row per shard, so a key's rows are few however often it occurs: one
        # exchange and a sort find its first place and whether it is alone
        same = W.partitionBy("gram", "window")
        rows = _rows(copy, ("gram", "window"), emit).select(
            "shard", "window", F.first("id").over(same.orderBy("id", "place")).alias("first_id"),
            F.first("place").over(same.orderBy("id", "place")).alias("first_place"), F.sum("n").over(same).alias("total"))
        return _handed_back(rows.where("total > 1").drop("total"), "open-windows")

    gram_table = open_grams()
    _release(copy)
    run_table = open_runs(partial(wholes, table=_Shards(gram_table, "gram")), "open-runs")
    _release(copy)
    tables = (run_table,)
    part_table = open_runs(partial(parts, tables=[_Shards(t, "whole") for t in tables]), "open-parts")
    _release(copy)
    tables = (run_table, part_table)
    window_table = open_windows(partial(windows, tables=[_Shards(t, "whole") for t in tables]))
    _release(copy)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, ones = [_Shards(t, "whole") for t in tables], _Shards(window_table, "window")
        for shard, ids, offs, data, prefix, piece in _pieces(batches):
            cover = np.zeros(len(data) + 1, np.int32)
            for later, firsts in found_runs(shard, ids, offs, data, prefix, runs):
                for r in later:
                    np.add.at(cover, r.low, 1)
                    np.add.at(cover, r.high + length, -1)
                run, start = _windows(firsts)
                found = ones.find(shard, K.span_hash(prefix, start, start + length))
                run, start, found = run[found >= 0], start[found >= 0], found[found >= 0]
                if len(found):
                    row = firsts.row[run]
                    place = start - offs[row]
                    start = start[~_first(found, ones.of(shard), ids[row], place)]
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            yield _cut_rows(piece, data, offs, gone)

    return arrow_map(copy, cut, "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _release(df: DataFrame) -> None:
    """Let the driver collect the finished round, so that the cleaner removes its shuffle
    files now and not at its next periodic collection."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()


def _cut_rows(piece: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.concatenate([[False], gone])
    after = np.concatenate([gone, [False]])
    begins = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    row = np.searchsorted(offs, begins, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(begins - offs[row]), pa.array(ends - offs[row])], ["start", "end"])
    n_rows = len(offs) - 1
    kept = np.concatenate([[0], np.cumsum(~gone)])[offs]
    return pa.RecordBatch.from_arrays(
        [piece.column("id"), pa.array(np.diff(offs)),
         pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_rows))]), pa.int32()), spans),
         pa.Array.from_buffers(pa.binary(), n_rows, [None, pa.py_buffer(kept.astype(np.int32)), pa.py_buffer(data[~gone])])],
        names=["id", "n_bytes", "spans", "kept"])
