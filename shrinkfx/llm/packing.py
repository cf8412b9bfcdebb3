"""Sum-of-squares online packing of token documents into fixed windows.

Documents arrive one by one. Windows of equal fill level are counted in a level array
(``grain`` tokens a level); a document goes to the level that minimises the sum of
squared counts of partially filled windows after the move, an empty window included.
Full windows' worth of a long document is cut off first, and a window left with less
room than a level is topped up from the next document, so every closed window is full.
At the end of a shard the few open windows are merged by cutting, and what is left of
the last one is laid out in windows whose lengths are powers of two, which need no
padding. A shard is one input partition: nothing is shuffled, memory holds the open
windows only, and a rerun of a task yields the same windows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.llm import textkit as K
from shrinkfx.llm.frames import arrow_map

WINDOW = 4096
GRAIN = 64
END_ID = 2
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")


class WordCoder:
    """Token ids of whole texts, one encoder call per distinct word.

    The tokenizer drops white space and never joins characters across it, so a text's
    ids are those of its words in order; a boundary between an ASCII letter and one of
    ``.,;:!?`` likewise always separates. Words of plain ASCII are lower-cased first, as
    the tokenizer does. The cache is emptied when it holds ``max_words``.
    """

    _PUNCT = np.zeros(256, bool)
    _PUNCT[list(b".,;:!?")] = True
    _LETTER = np.zeros(256, bool)
    _LETTER[[*range(65, 91), *range(97, 123)]] = True

    def __init__(self, path: str, max_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        self._clear()

    def _clear(self) -> None:
        # known words by hash, in order, and the place of each in ``begin`` and ``count``:
        # 12 bytes a word, where a dictionary takes ten times that
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _add(self, hashes: np.ndarray, texts: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        n, m = len(self.keys), int(sizes.sum())
        while self.used + m > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(got) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.pool[self.used: self.used + m] = np.fromiter((i for x in got for i in x), np.uint32, m)
        self.begin[n: n + len(got)] = self.used + np.cumsum(sizes) - sizes
        self.count[n: n + len(got)] = sizes
        at = np.searchsorted(self.keys, hashes)  # both are sorted
        self.keys = np.insert(self.keys, at, hashes)
        self.place = np.insert(self.place, at, np.arange(n, n + len(got), dtype=np.int32))
        self.used += m

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 for a word not met yet."""
        if len(self.keys) == 0:
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.place[at], -1)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, ids per row)."""
        n_rows = len(offs) - 1
        starts, ends, _ = K.words(data, offs)
        if len(starts) == 0:
            return np.zeros(0, np.uint32), np.zeros(n_rows, np.int64)
        cut = np.flatnonzero(self._LETTER[data[:-1]] & self._PUNCT[data[1:]]) + 1
        edge = np.zeros(len(data) + 1, bool)
        edge[offs] = True
        cut = cut[~edge[cut]]
        # cuts lie inside words: no place occurs twice
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data >= 128) | (data == 60), out=odd[1:])
        low = K.lower_ascii(data)
        h = np.where(odd[ends] > odd[starts], K.span_hash(K.prefix_hash(data), starts, ends),
                     K.span_hash(K.prefix_hash(low), starts, ends))
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > self.max_words:
            self._clear()
        known = self._known(uniq)
        new = np.flatnonzero(known < 0)
        if len(new):
            n = len(self.keys)
            raw = data.tobytes()
            self._add(uniq[new], [raw[starts[first[i]]: ends[first[i]]].decode("utf-8", "replace") for i in new])
            known[new] = np.arange(n, n + len(new))
        at = known[back]
        sizes = self.count[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.begin[at] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(starts, offs)])


_coders: dict[str, WordCoder] = {}


def coder_for(path: str) -> WordCoder:
    """The worker process's coder, kept from task to task."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


class SumOfSquares:
    """The packer of one shard. ``add`` and ``finish`` return closed windows, each a list
    of pieces (doc_id, start, ids, tokens of the document)."""

    def __init__(self, window: int = WINDOW, grain: int = GRAIN):
        self.window, self.grain, self.top = window, grain, -(-window // grain)
        self.level = np.zeros(self.top + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(self.top + 1)]
        self.short: list[list] = []  # windows with less room than a level

    @staticmethod
    def _fill(window: list) -> int:
        return sum(len(p[2]) for p in window)

    def _choose(self, n: int) -> int:
        """The level to which a piece of ``n`` tokens goes (0: an empty window)."""
        step = -(-n // self.grain)
        h = np.arange((self.window - n) // self.grain + 1)
        to = h + step
        cost = np.where(to >= self.top, 0, 2 * self.level[np.minimum(to, self.top)] + 1)
        cost[1:] += np.where(self.level[1: len(h)] > 0, 1 - 2 * self.level[1: len(h)], 1 << 40)
        return int(len(h) - 1 - np.argmin(cost[::-1]))  # the fullest of equals

    def add(self, doc_id, ids: np.ndarray) -> Iterator[list]:
        at, n = 0, len(ids)
        while at < n:
            if self.short:
                window = self.short.pop()
                room = self.window - self._fill(window)
            elif n - at >= self.window:
                window, room = [], self.window
            else:
                h = self._choose(n - at)
                window, room = [], n - at
                if h:
                    window = self.open[h].pop()
                    self.level[h] -= 1
            piece = ids[at: at + room]
            window.append((doc_id, at, piece, n))
            at += len(piece)
            fill = self._fill(window)
            if fill == self.window:
                yield window
            elif self.window - fill < self.grain:
                self.short.append(window)
            else:
                h = -(-fill // self.grain)
                self.open[h].append(window)
                self.level[h] += 1

    def finish(self) -> Iterator[list]:
        left = sorted([*self.short, *(w for ws in self.open for w in ws)], key=self._fill, reverse=True)
        while len(left) > 1:
            room = self.window - self._fill(left[0])
            while room and len(left) > 1:
                doc, start, ids, n = left[-1].pop()
                left[0].append((doc, start, ids[:room], n))
                if len(ids) > room:
                    left[-1].append((doc, start + room, ids[room:], n))
                room -= min(room, len(ids))
                if not left[-1]:
                    left.pop()
            if room == 0:
                yield left.pop(0)
        pieces = left[0] if left else []
        rest = sum(len(p[2]) for p in pieces)
        while rest:
            size, window = 1 << (rest.bit_length() - 1), []
            rest -= size
            while size:
                doc, start, ids, n = pieces.pop(0)
                window.append((doc, start, ids[:size], n))
                if len(ids) > size:
                    pieces.insert(0, (doc, start + size, ids[size:], n))
                size -= min(size, len(ids))
            yield window


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = END_ID, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """One row per piece (``PIECES``); ``ids`` holds little-endian unsigned 32-bit ids.

    A document's ids are its text's, then ``end_id``; a null or empty text is the end id
    alone. Rows are packed one by one, so rows with equal or null ids are packed as often
    as they occur. Other columns are ignored; no rows in, no rows out. ``sequence_id`` is
    the shard's number times 2**32 plus the window's number there.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    types = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens",
                                                 "sequence_id", "offset")] + [("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = coder_for(tokenizer_path), SumOfSquares(window, grain)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        out: list[tuple] = []

        def put(closed: Iterator[list]) -> None:
            nonlocal number
            for pieces in closed:
                offset = 0
                for doc, start, ids, n in pieces:
                    out.append((doc, start, len(ids), n, number, offset, ids.astype("<u4").tobytes()))
                    offset += len(ids)
                number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(types)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, types)], schema=types)

        for batch in batches:
            for part in K.slices(batch, "text"):
                data, offs = K.flat(part.column("text"))
                ids, counts = coder.encode(data, offs)
                ends = np.cumsum(counts)
                for doc, a, b in zip(part.column("doc_id").to_pylist(), ends - counts, ends):
                    put(packer.add(doc, np.append(ids[a:b], np.uint32(end_id))))
                yield flush()
        put(packer.finish())
        yield flush()

    return arrow_map(rows, run, PIECES)
