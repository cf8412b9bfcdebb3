"""MinHash near-deduplication with fast similarity sketching.

Sketch: every shingle is thrown into one of ``t`` bins round after round, each round with
its own hash; a bin keeps the least (round, hash) it has seen. After ``t`` such rounds
round ``t + i`` throws every shingle into bin ``i``, so all bins are filled for sure; a
set leaves the rounds as soon as it has filled its bins, which costs about
max(n, t log t) hashes. Bin values of two sets agree with probability J, with the
concentration of independent samples.

Candidates: sets with equal contents are one class. Classes that agree on all rows of a
band meet in a bucket. A bucket is joined like a star: its members are compared with its
smallest member only. Members that turn out not to be linked to it are compared with the
members of other components of the bucket, until every bucket's members are in one
component or have been compared. So a bucket of n near copies costs about n comparisons,
not n * n. Every comparison is exact, on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shrinkfx.llm import textkit as K
from shrinkfx.llm.components import components
from shrinkfx.llm.frames import arrow_map, own
from shrinkfx.session import materialize


@dataclass(frozen=True)
class Sketch:
    """``bands * rows`` bins. A pair of similarity s shares a band with probability
    1 - (1 - s**rows)**bands: at 0.85, 0.9999997; at 0.5, 0.40."""

    words: int = 5
    bands: int = 32
    rows: int = 6
    percent: int = 85
    seed: int = 3


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, shingles per row): the distinct word n-grams of each row of
    lower-cased text, sorted; a row with fewer words has its whole sequence as one."""
    data = K.lower_ascii(data)
    starts, ends, per_row = K.words(data, offs)
    h = K.span_hash(K.prefix_hash(data), starts, ends)
    begin = np.cumsum(per_row) - per_row
    row = K.row_of(per_row)
    left = per_row[row] - (np.arange(len(h)) - begin[row])  # words from here to the row's end
    first = np.flatnonzero(left >= words)
    grams, owner = K.gram_hash(h, first, words), row[first]
    for n in range(1, words):  # short rows
        short = np.flatnonzero(per_row == n)
        if len(short):
            grams = np.concatenate([grams, K.gram_hash(h, begin[short], n)])
            owner = np.concatenate([owner, short])
    # by hash, then (stable, a radix sort on 16 bits) by row: a slice has at most 4096 rows
    order = np.argsort(grams)
    order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.bincount(owner[new], minlength=len(per_row))


def fast_sketch(grams: np.ndarray, counts: np.ndarray, t: int, seed: int) -> np.ndarray:
    """Sketches (rows x t) of the sets; rows of empty sets are meaningless."""
    n_rows = len(counts)
    best = np.full((n_rows, t), np.iinfo(np.uint64).max)
    owner, live, flat = K.row_of(counts), grams, best.reshape(-1)
    rounds = K.mix(np.arange(1, 2 * t + 1, dtype=np.uint64) * np.uint64(2 * seed + 1))
    for r in range(2 * t):
        if len(live) == 0:
            break
        h = K.mix(live ^ rounds[r])
        if r < t:
            bins = ((h >> np.uint64(40)) * np.uint64(t)) >> np.uint64(24)
        else:
            bins = np.full(len(h), r - t, np.uint64)
        # round in the top bits: an earlier round always wins
        value = (np.uint64(r) << np.uint64(54)) | (h & np.uint64((1 << 40) - 1)) << np.uint64(14) | (h >> np.uint64(50))
        np.minimum.at(flat, owner * t + bins.astype(np.int64), value)
        # sets with all bins filled are done; counts shrink quickly
        rows = np.flatnonzero(np.bincount(owner, minlength=n_rows))
        open_rows = rows[(best[rows] == np.iinfo(np.uint64).max).any(axis=1)]
        if len(open_rows) < len(rows):
            still = np.zeros(n_rows, bool)
            still[open_rows] = True
            keep = still[owner]
            live, owner = live[keep], owner[keep]
    return best


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band: a hash of the band's number and its ``rows`` bins."""
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), 1))
    for r in range(rows):
        keys = K.mix(keys * np.uint64(31) + sketch[:, r * bands: (r + 1) * bands])
    return keys


def sketches(docs: DataFrame, sketch: Sketch, id_col: str, text_col: str) -> DataFrame:
    """(id, n, low, high, bands) for every row: set size, a 128-bit digest of the set and
    the band keys (empty for an empty set). One pass, no shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = sketch.bands * sketch.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                grams, counts = shingle_sets(*K.flat(part.column("text")), sketch.words)
                keys = band_keys(fast_sketch(grams, counts, t, sketch.seed), sketch.bands, sketch.rows)
                low, high = _digests(grams, counts)
                full = counts > 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(full * sketch.bands)]), pa.int32()),
                    pa.array(keys[full].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(counts.astype(np.int64)), pa.array(low), pa.array(high), lists],
                    names=["id", "n", "low", "high", "bands"])

    return arrow_map(rows, run, "id long, n long, low long, high long, bands array<long>")


PARITY_BITS = 512


def parities(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Odd sketches (rows x 8 words): bit k is the parity of the set's shingles that hash to
    k. Two sketches differ in no more bits than the sets differ in shingles."""
    place = K.row_of(counts) * PARITY_BITS + (K.mix(grams) % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = np.bincount(place, minlength=len(counts) * PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, 64), axis=1).view(np.int64).reshape(len(counts), -1)


def _digests(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set."""
    at = np.concatenate([[0], np.cumsum(counts)])
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in
            (K.mix(grams), K.mix(grams ^ np.uint64(0xA5A5A5A55A5A5A5A)))]
    return tuple((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)


def _sets(docs: DataFrame, wanted: DataFrame, sketch: Sketch, id_col: str, text_col: str) -> DataFrame:
    """(cls, grams, parity) of the wanted classes (id, cls): the texts of the ids are read
    again and shingled; a text of the id that is of another class is not wanted."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(wanted.select("id").distinct(), "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                grams, counts = shingle_sets(*K.flat(part.column("text")), sketch.words)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                                 pa.array(grams.view(np.int64)))
                parity = parities(grams, counts)
                words = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * parity.shape[1], pa.int32()),
                                                 pa.array(parity.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(_digests(grams, counts)[0]), lists, words],
                                                 names=["id", "cls", "grams", "parity"])

    made = arrow_map(rows, run, "id long, cls long, grams array<long>, parity array<long>")
    return made.join(wanted, ["id", "cls"], "left_semi").drop("id")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, counted on the full sets."""
    a, b = (sets.select(F.col("cls").alias(x), F.col("grams").alias(f"{x}_grams")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                x, y = (np.asarray(batch.column(c)[i].values).view(np.uint64) for c in ("a_grams", "b_grams"))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                out.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(out, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)

    return arrow_map(pairs.join(a, "a").join(b, "b").select("a", "b", "a_grams", "b_grams"), run, "a long, b long")


def _fits(percent: int, a: Column, b: Column) -> Column:
    """Sizes between which the similarity can be reached."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _contested_pairs(contested: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of contested classes of different components that can still be similar.

    Shingles are ranked from rare to common among the contested sets. Similar sets share
    a shingle among the first n - ceil(s * n) + 1 of each, and the places of their first
    common one bound their overlap; their odd sketches bound it from above as well, as
    similar sets differ in few shingles. Only pairs that pass both bounds, which lose no
    similar pair, are emitted. Shingles held by one set alone fill places but need no row."""
    rows = sets.join(contested, "cls").select(
        "cls", "comp", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    rows = materialize(rows, "minhash-contested")
    common = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (rows.join(common, "gram").groupBy("cls")
              .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("gs"), F.first("comp").alias("comp"),
                   F.first("n").alias("n")).join(sets.select("cls", "parity"), "cls"))
    alone = F.col("n") - F.size("gs")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone
    prefixes = materialize(
        ranked.where(prefix > 0).select("cls", "comp", "n", "parity", alone.alias("alone"),
                                        F.posexplode(F.slice("gs", 1, F.greatest(prefix, F.lit(1)).cast("int"))).alias("k", "g"))
        .select("cls", "comp", "n", (F.col("alone") + F.col("k")).alias("at"), F.col("g.gram").alias("gram"),
                *[F.col("parity")[i].alias(f"p{i}") for i in range(PARITY_BITS // 64)]),
        "minhash-prefixes")
    words = [f"p{i}" for i in range(PARITY_BITS // 64)]
    x, y = (prefixes.select("gram", *[F.col(c).alias(f"{s}_{c}") for c in ("cls", "comp", "n", "at", *words)]) for s in "xy")
    n_x, n_y = F.col("x_n"), F.col("y_n")
    overlap = F.least(n_x - F.col("x_at"), n_y - F.col("y_at"))
    can = (F.col("x_cls") < F.col("y_cls")) & (F.col("x_comp") != F.col("y_comp")) & _fits(percent, n_x, n_y) & (
        overlap * (100 + percent) >= (n_x + n_y) * percent) & (
        reduce(add, [F.bit_count(F.col(f"x_{p}").bitwiseXOR(F.col(f"y_{p}"))) for p in words]) * (100 + percent)
        <= (n_x + n_y) * (100 - percent))
    return x.join(y, (x["gram"] == y["gram"]) & can).select(
        F.col("x_cls").alias("a"), F.col("y_cls").alias("b")).distinct()


def near_duplicates(docs: DataFrame, sketch: Sketch = Sketch(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    A document without words (null, empty, white space) has no shingles and is linked to
    nothing. The component is named by its smallest id. Rows with equal ids are one
    document: all texts of an id are linked with each other. A row without id is judged by
    equal sets alone. Very long texts are shingled whole. No rows in, no rows out."""
    s = materialize(sketches(docs, sketch, id_col, text_col), "minhash-sketches")
    key = ["n", "low", "high"]
    # one class per distinct set, named by a digest of the set, with the sketch and the
    # smallest id of its rows (equal sets, equal sketches)
    classes = materialize(s.where("n > 0").groupBy(*key).agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"), F.min_by("bands", "id").alias("bands"))
        .withColumn("cls", F.col("low")), "minhash-classes")
    banded = classes.where("id is not null").select("cls", "id", "n", F.explode("bands").alias("key"))
    stars = (banded.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("c"), F.count(F.lit(1)).alias("m"))
             .where("m > 1").select("key", F.col("c.cls").alias("center"), F.col("c.n").alias("center_n")))
    members = materialize(banded.join(stars, "key"), "minhash-members")
    sets = materialize(_sets(docs, members.select("id", "cls").distinct(), sketch, id_col, text_col)
                       .dropDuplicates(["cls"]), "minhash-sets")
    to_center = members.where((F.col("cls") != F.col("center")) & _fits(sketch.percent, F.col("n"), F.col("center_n")))
    links = _linked(to_center.select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct(), sets, sketch.percent)
    # texts of one id: its least class with each other one
    several = s.where("n > 0 and id is not null").groupBy("id").agg(
        F.min("low").alias("a"), F.max("low").alias("top")).where("a < top").select("id", "a")
    links = materialize(links.union(s.where("n > 0").join(several, "id").where("a <> low").select("a", F.col("low").alias("b"))),
                        "minhash-links")
    first = components(links)
    placed = members.join(first, members["cls"] == first["id"], "left").select(
        "key", "cls", F.coalesce("component", "cls").alias("comp"))
    placed = materialize(placed, "minhash-placed")
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    contested = placed.join(split, "key", "left_semi").select("cls", "comp").distinct()
    more = _linked(_contested_pairs(contested, sets, sketch.percent), sets, sketch.percent)
    final = components(links.union(more)).withColumnRenamed("id", "cls")
    # components are named by a class: its smallest id is their name. Classes of one row
    # that no link reaches need no join
    group = F.coalesce("component", "cls")
    grouped = materialize(classes.join(final, "cls", "left").select(*key, "id", "rows", group.alias("grp")), "minhash-grouped")
    names = grouped.groupBy("grp").agg(F.min("id").alias("component"), F.sum("rows").alias("all")).where("all > 1")
    named = grouped.join(names, "grp").select(*key, "component")
    return (s.join(named, key, "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def judge(docs: DataFrame, sketch: Sketch = Sketch(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with ``kept``: whether the row is its component's smallest id."""
    return near_duplicates(docs, sketch, id_col, text_col).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id")))


def keep_smallest(docs: DataFrame, sketch: Sketch = Sketch(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, columns as they were.
    A row without id stays if no row with an id has an equal set; of several such rows with
    equal sets one stays."""
    dropped = judge(docs, sketch, id_col, text_col).where("not kept").select(F.col("id").alias("_nd_id")).distinct()
    kept = own(docs.join(dropped, F.col(f"`{id_col}`") == F.col("_nd_id"), "left_anti"), docs.columns)
    unnamed = docs.where(F.col(f"`{id_col}`").isNull())
    if unnamed.isEmpty():
        return kept
    unnamed = materialize(unnamed.withColumn("_nd_row", F.monotonically_increasing_id()), "minhash-unnamed")
    key = ["n", "low", "high"]
    classes = materialize(sketches(unnamed, sketch, "_nd_row", text_col).select("id", *key), "minhash-unnamed-sets")
    named = sketches(docs.where(F.col(f"`{id_col}`").isNotNull()), sketch, id_col, text_col).select(*key).distinct()
    stay = (classes.where("n > 0").join(named, key, "left_anti").groupBy(*key).agg(F.min("id").alias("_nd_row")).select("_nd_row")
            .union(classes.where("n = 0").select(F.col("id").alias("_nd_row"))))
    return kept.where(F.col(f"`{id_col}`").isNotNull()).union(
        own(unnamed.join(stay, "_nd_row", "left_semi"), docs.columns))
