"""Quality rules: compression bands.

A document is compressed whole and in fixed chunks with zstandard. Repetitive text
compresses too well, random text hardly at all; both limits depend on the length of
what is compressed, since short inputs always compress less. A document stays if its
whole ratio lies inside the band of its length and no more than a share of its chunks
leaves the band of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shrinkfx.llm import textkit as K
from shrinkfx.llm.frames import arrow_map, own


@dataclass(frozen=True)
class Bands:
    """Limits on compressed / raw size: ``bands`` holds (bytes up to, lowest, highest),
    the last for all longer inputs. ``bad_chunks`` is the share of chunks that may leave
    their band.

    Prose in an alphabetic script compresses to about 0.63 of 0.5 KB, 0.57 of 1 KB, 0.48 of
    4 KB and 0.42 of 64 KB; words of random letters stay near 0.6 and hexadecimal words near
    0.53 at any length, template lines fall to 0.2 from 2 KB on. Up to 2 KB random and
    ordinary text overlap, so the upper limits bite beyond that."""

    level: int = 3
    chunk_bytes: int = 4096
    bands: tuple[tuple[int, float, float], ...] = (
        (256, 0.25, 1.10), (512, 0.40, 0.90), (1024, 0.33, 0.80), (2048, 0.30, 0.66), (4096, 0.28, 0.56),
        (8192, 0.26, 0.52), (16384, 0.25, 0.51), (1 << 62, 0.22, 0.50))
    bad_chunks: float = 0.5

    def limits(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted([b[0] for b in self.bands], n)
        low, high = (np.array([b[i] for b in self.bands]) for i in (1, 2))
        return low[at], high[at]


BASE = T.StructType([T.StructField(n, T.LongType()) for n in
                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows equal to an earlier row, rows with an equal row) of ``keys``."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return later, any_


def base_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The plain rules' counts for each row of a slice."""
    starts, ends, per_row = K.words(data, offs)
    rows = K.row_of(per_row)
    prefix = K.prefix_hash(data)
    word = K.span_hash(prefix, starts, ends)
    n_rows = len(offs) - 1
    salt = K.mix(np.arange(n_rows, dtype=np.uint64) + np.uint64(1))
    covered = np.zeros(len(word) + 3, np.int64)
    first = np.flatnonzero(rows[2:] == rows[:-2]) if len(word) > 2 else np.zeros(0, np.int64)
    if len(first):
        _, repeated = _repeats(K.gram_hash(word, first, 3) + salt[rows[first]])
        at = first[repeated]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 3, -1)
    in_repeat = np.cumsum(covered)[: len(word)] > 0
    newline = np.flatnonzero(data == 10)
    edges = np.sort(np.concatenate([offs, newline, newline + 1]))
    line_s, line_e = edges[:-1], edges[1:]
    # a line holds a word: the newline byte itself forms spans without words
    holds = np.searchsorted(starts, line_e) > np.searchsorted(starts, line_s)
    line_s, line_e = line_s[holds], line_e[holds]
    line_row = np.searchsorted(offs, line_s, "right") - 1
    later, _ = _repeats(K.span_hash(prefix, line_s, line_e) + salt[line_row])
    chars = (data & 0xC0) != 0x80
    return {"n_words": per_row, "word_chars": K.row_sums(chars & ~K._SPACE[data], offs),
            "n_symbols": K.row_sums(_SYMBOL[data], offs),
            "n_dup_lines": np.bincount(line_row[later], minlength=n_rows),
            "n_repeat_words": np.bincount(rows[in_repeat], minlength=n_rows)}


def _ratios(data: np.ndarray, offs: np.ndarray, b: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(whole ratio, share of bad chunks) of each row; empty rows: (1, 0)."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=b.level, write_content_size=False, write_checksum=False)
    raw, n_rows = memoryview(np.ascontiguousarray(data)), len(offs) - 1
    whole, bad = np.ones(n_rows), np.zeros(n_rows)
    for i in range(n_rows):
        s, e = int(offs[i]), int(offs[i + 1])
        if s == e:
            continue
        whole[i] = len(pack.compress(raw[s:e])) / (e - s)
        if e - s > b.chunk_bytes:
            cuts = np.append(np.arange(s, e, b.chunk_bytes), e)
            size = np.diff(cuts)
            ratio = np.array([len(pack.compress(raw[x:y])) for x, y in zip(cuts[:-1], cuts[1:])]) / size
            low, high = b.limits(size)
            bad[i] = ((ratio < low) | (ratio > high)).mean()
    return whole, bad


def measure(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """``docs`` with a struct column ``_ql`` of counts, ratios and verdicts (see ``judge``).

    One pass over the rows, no shuffle: Arrow batches are cut into slices of about 2 MB."""
    added = T.StructType(BASE.fields + [
        T.StructField("zstd_ratio", T.DoubleType()), T.StructField("bad_chunk_share", T.DoubleType()),
        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])
    names = [f.name for f in added.fields]
    rows = docs.select("*", F.coalesce(F.col(text_col), F.lit("")).alias("_ql_text"))
    carried = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "_ql_text"):
                data, offs = K.flat(part.column("_ql_text"))
                c = base_counts(data, offs)
                whole, bad = _ratios(data, offs, bands)
                n, rep = c["n_words"], c["n_repeat_words"]
                failed = (n < 50) | (100 * rep > 50 * n)
                low, high = bands.limits(np.diff(offs))
                kept = ~failed & (whole >= low) & (whole <= high) & (bad <= bands.bad_chunks)
                c |= {"zstd_ratio": whole, "bad_chunk_share": bad, "base_failed": failed, "kept": kept}
                struct = pa.StructArray.from_arrays([pa.array(c[k]) for k in names], names)
                yield pa.RecordBatch.from_arrays(
                    [part.column(x) for x in carried] + [struct], names=[*carried, "_ql"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_ql", added)])
    return arrow_map(rows, run, schema)


def judge(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """Every row of ``docs`` with its counts, ``zstd_ratio``, ``bad_chunk_share``,
    ``base_failed`` (under 50 words, or over half of the words in repeated 3-word windows)
    and ``kept``. Null or empty text has no words and fails. Rows are judged alone, so
    repeated rows get equal verdicts. Input columns that bear the added names are
    replaced; no rows in, no rows out."""
    m = measure(docs, text_col, bands)
    fields = [f.name for f in m.schema["_ql"].dataType.fields]
    kept = [c for c in docs.columns if c.lower() not in fields]
    return m.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"_ql.{f}").alias(f) for f in fields])


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows that pass, with the columns of ``docs``."""
    return own(measure(docs, text_col, bands).where("_ql.kept"), docs.columns)
