"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained with follow-the-regularised-leader and elastic-net penalties, then
calibrated by temperature.

N-grams of one to three code points (ASCII letters in lower case) of the whole text are
hashed into ``bins``. Document frequencies count all training documents in Spark. The
weights are fitted on a documented bounded sample (``per_language`` texts per language on
average, chosen by hash), a fifth of which is held back for the temperature. Prediction is one pass over all
documents with the weights (bins x languages) in the task's closure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shrinkfx.llm import textkit as K
from shrinkfx.llm.frames import arrow_map

BIN_BITS = 16


@dataclass(frozen=True)
class Training:
    """``alpha`` and ``beta`` set the per-coordinate learning rate, ``l1`` and ``l2`` the
    penalties, ``per_language`` the bound of the sample."""

    per_language: int = 1200
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # languages x bins, float32, idf included
    idf: np.ndarray
    temperature: float


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first feature of each row and the end, bins, counts): the distinct n-gram bins of
    each row with their counts."""
    n_rows = len(offs) - 1
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offs]
    points = np.frombuffer(K.lower_ascii(data).tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.minimum(at, len(points))
    row = K.row_of(np.diff(at)).astype(np.uint32)
    points = points[: len(row)].astype(np.uint64)
    keys, h = [], np.zeros(len(points), np.uint64)
    for n in range(1, 4):
        if len(points) < n:
            break
        # h holds the hash of the n-1 points from each place
        h = (h[: len(points) - n + 1] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) ^ (
            points[n - 1:] * np.uint64(0xD6E8FEB86659FD93))
        inside = row[n - 1:] == row[: len(points) - n + 1]
        bins = (K.mix(h) >> np.uint64(64 - BIN_BITS)).astype(np.uint32)
        keys.append(((row[: len(bins)] << np.uint32(BIN_BITS)) | bins)[inside])
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint32)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    first = np.searchsorted(keys >> np.uint32(BIN_BITS), np.arange(n_rows + 1))
    return first, (keys & np.uint32((1 << BIN_BITS) - 1)).astype(np.int64), counts


def _weighted(first: np.ndarray, bins: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values, each row of length one."""
    v = (1 + np.log(counts)) * idf[bins]
    per_row = np.diff(first)
    # summed row by row, so a text's values do not depend on its neighbours
    norm = np.sqrt(np.bincount(K.row_of(per_row), v * v, minlength=len(per_row)))
    return v / np.repeat(norm, per_row)


def _texts(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Documents that hold each bin, over all of ``docs`` (at most 2**16 rows come back)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BIN_BITS, np.int64)
        for batch in batches:
            for part in K.slices(batch, "text"):
                total += np.bincount(features(*K.flat(part.column("text")))[1], minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bin", "n"])

    df = np.zeros(1 << BIN_BITS)
    for r in arrow_map(_texts(docs, text_col), run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        df[r["bin"]] = r["n"]
    return df


def _sample(docs: DataFrame, counts: dict[str, int], t: Training, id_col: str, text_col: str,
            lang_col: str) -> list[tuple[int, bool, np.ndarray, np.ndarray]]:
    """(language number, for calibration, bins, counts) of the sampled documents."""
    langs = sorted(counts)
    u = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), F.col(id_col)), 11) / float(1 << 53)
    share = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, t.per_language / counts[k]))]),
                         F.col(lang_col))
    held_back = F.pmod(F.xxhash64(F.lit("calibrate"), F.col(id_col)), F.lit(5)) == 0
    rows = _texts(docs.where(u < share), text_col, F.col(lang_col).alias("lang"), held_back.alias("cal"),
                  F.xxhash64(F.lit("order"), F.col(id_col)).alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                first, bins, n = features(*K.flat(part.column("text")))
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x.astype(np.int32))) for x in (bins, n)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("lang", "cal", "place")] + lists,
                                                 names=["lang", "cal", "place", "bins", "n"])

    got = arrow_map(rows, run, "lang string, cal boolean, place long, bins array<int>, n array<int>").toArrow()
    number = {k: i for i, k in enumerate(langs)}
    out = [(place, number[lang], cal, np.asarray(got.column("bins")[i].values), np.asarray(got.column("n")[i].values))
           for i, (lang, cal, place) in enumerate(zip(*(got.column(c).to_pylist() for c in ("lang", "cal", "place"))))]
    return [x[1:] for x in sorted(out, key=lambda x: x[0]) if len(x[3])]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=0, keepdims=True))
    return e / e.sum(axis=0, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, dims: int, t: Training) -> np.ndarray:
    """Weights (classes x dims) from (class, bins, values) rows, taken one by one."""
    z, n = np.zeros((classes, dims)), np.zeros((classes, dims))

    def weights(zb: np.ndarray, nb: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zb) <= t.l1, 0.0, -(zb - np.sign(zb) * t.l1) / ((t.beta + np.sqrt(nb)) / t.alpha + t.l2))

    for _ in range(t.epochs):
        for y, bins, x in rows:
            zb, nb = z[:, bins], n[:, bins]
            w = weights(zb, nb)
            p = _softmax((w @ x)[:, None])[:, 0]
            p[y] -= 1
            g = p[:, None] * x
            z[:, bins] = zb + g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / t.alpha * w
            n[:, bins] = nb + g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows, by golden section on its log.
    As in Platt scaling the targets leave one error in n + 2 to the other classes, so a
    flawless held-back set does not make every score 1."""
    classes, n = logits.shape
    if n == 0 or classes < 2:
        return 1.0
    target = np.full((classes, n), 1 / (n + 2) / (classes - 1))
    target[y, np.arange(n)] = 1 - 1 / (n + 2)

    def loss(a: float) -> float:
        z = logits / np.exp(a)
        z = z - z.max(axis=0)
        return float(np.mean(np.log(np.exp(z).sum(axis=0)) - (target * z).sum(axis=0)))

    lo, hi, g = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          training: Training = Training()) -> Model:
    """Fit on the rows of ``docs`` whose language and id are known. No such rows: a model
    without languages."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    df = document_frequencies(known, text_col)
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 1
    if not counts:
        return Model((), np.zeros((0, len(idf)), np.float32), idf, 1.0)
    rows = [(y, cal, bins, _weighted(np.array([0, len(bins)]), bins, n, idf))
            for y, cal, bins, n in _sample(known, counts, training, id_col, text_col, lang_col)]
    w = fit_ftrl([(y, b, x) for y, cal, b, x in rows if not cal], len(counts), len(idf), training)
    held = [(y, w[:, b] @ x) for y, cal, b, x in rows if cal]
    temperature = fit_temperature(np.array([z for _, z in held]).reshape(-1, len(counts)).T,
                                  np.array([y for y, _ in held], int))
    return Model(tuple(sorted(counts)), w.astype(np.float32), idf, temperature)


def _no_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    low = K.lower_ascii(data)
    letters = K.row_sums((low >= 97) & (low <= 122), offs)
    wide = K.row_sums(data >= 128, offs)
    none = letters == 0
    for i in np.flatnonzero(none & (wide > 0)):
        none[i] = not any(map(str.isalpha, data[offs[i]: offs[i + 1]].tobytes().decode("utf-8", "replace")))
    return none


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (calibrated probability).

    A text that is null or has no letter is ``und`` with score 0, as is every text under a
    model without languages. Equal texts get equal answers, ties the first language.
    Input columns of these names are replaced; no rows in, no rows out."""
    carried = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.coalesce(F.col(text_col), F.lit("")).alias("_li_text"))

    # weights are languages x 2**16 numbers, however many rows were learned from
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            for part in K.slices(batch, "_li_text"):
                data, offs = K.flat(part.column("_li_text"))
                pick, score = np.full(len(offs) - 1, len(names) - 1), np.zeros(len(offs) - 1)
                some = np.flatnonzero(~_no_letter(data, offs))
                if len(model.languages) and len(some):
                    first, bins, counts = features(data, offs)
                    x = _weighted(first, bins, counts, model.idf)
                    z = np.stack([np.bincount(K.row_of(np.diff(first)), x * w[bins], minlength=len(pick))
                                  for w in model.weights])
                    p = _softmax(z[:, some] / model.temperature)
                    pick[some], score[some] = p.argmax(axis=0), p.max(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carried] + [pa.array(names[pick], pa.string()), pa.array(score)],
                    names=[*carried, "lang_pred", "score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
                       + ["lang_pred string", "score double"])
    return arrow_map(rows, run, schema)
