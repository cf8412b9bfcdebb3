"""Mixing sources to target weights under a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1], piecewise linear
between knots. Its integral, scaled to the source's target, is the cumulative token
demand of the source; a document that occupies the words [a, b) of its source's stream
is due when demand reaches its middle, so inverting the demand gives the document's
training position. Documents are then range-sorted by position.

Targets share ``budget_ratio`` of all words by weight, none above ``max_epochs`` times
its source; the excess is shared again by weight. That fixed point is
``min(cap, level * weight)`` for one level, found on the per-source table by sorting
sources by cap / weight. A source's stream lists its documents by hash order, as many
epochs as its target needs. Offsets in the stream come from bucket totals plus a window
inside each bucket, so no task ever sorts a whole source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shrinkfx.llm.frames import annotated, own
from shrinkfx.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
#: knots of (time, relative weight): a source starts strong, stays level or ends strong
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 2048
HASH_BITS = 60


def _segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(share at the start, share at the end, t0, weight at t0, slope) of each piece,
    shares being the integral up to there over the whole integral."""
    area, pieces = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        pieces.append((area, area + (t1 - t0) * (w0 + w1) / 2, t0, w0, (w1 - w0) / (t1 - t0)))
        area = pieces[-1][1]
    return [(a / area, b / area, t, w / area, m / area) for a, b, t, w, m in pieces]


def invert_schedule(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the schedule's integral reaches ``share`` of its total."""
    out = F.lit(float(knots[-1][0]))
    for a, b, t0, w0, slope in reversed(_segments(knots)):
        need = share - a
        if abs(slope) < 1e-12:
            t = t0 + need / w0
        else:
            t = t0 + (F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * need)) - w0) / slope
        out = F.when(share <= b, t).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   budget_ratio: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """One row per source (``_mx_source``): rank in code-point order (null last), words,
    documents and target. ``sizes`` has ``_mx_source`` and ``_mx_size``. The table has one
    row per source, so its windows are small."""
    per = sizes.groupBy("_mx_source").agg(F.sum("_mx_size").alias("_mx_words"),
                                          F.count(F.lit(1)).alias("_mx_docs"))
    names = W.orderBy(F.col("_mx_source").asc_nulls_last())
    ranked = per.withColumn("_mx_rank", F.row_number().over(names) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_mx_rank") % len(weights) + 1).cast("int"))
    whole = W.partitionBy()
    caps = ranked.withColumns({
        "_mx_weight": w, "_mx_cap": max_epochs * F.col("_mx_words"),
        "_mx_budget": budget_ratio * F.sum("_mx_words").over(whole)})
    by_ratio = W.orderBy(F.col("_mx_cap") / F.col("_mx_weight"), "_mx_rank")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    # the level if this source is the first that is not capped
    level = ((F.col("_mx_budget") - F.coalesce(F.sum("_mx_cap").over(before), F.lit(0.0)))
             / F.sum("_mx_weight").over(after))
    levels = caps.withColumn("_mx_level", level)
    fits = F.col("_mx_level") * F.col("_mx_weight") <= F.col("_mx_cap")
    chosen = levels.withColumn("_mx_level", F.min(F.when(fits, F.struct(
        F.col("_mx_cap") / F.col("_mx_weight"), "_mx_rank", "_mx_level"))).over(whole)["_mx_level"])
    target = F.least("_mx_cap", F.coalesce(F.col("_mx_level") * F.col("_mx_weight"), F.col("_mx_cap")))
    return chosen.select("_mx_source", "_mx_rank", "_mx_words", "_mx_docs", target.alias("_mx_target"))


def stream_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """The place of a document in its source's stream: 60 bits of an md5 of seed and id
    (of the text where there is no id), which other engines can compute too."""
    name = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), name).cast("binary")), 1, 15), 16, 10).cast("long")


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float],
            schedules: Sequence[Sequence[tuple[float, float]]], budget_ratio: float,
            max_epochs: float, seed: int) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("*", F.col(source_col).alias("_mx_source"), size.alias("_mx_size"),
                       stream_hash(F.col(id_col), F.col(text_col), seed).alias("_mx_hash"),
                       F.xxhash64(F.col(text_col)).alias("_mx_text"))  # tells rows of one id apart
    targets = materialize(source_targets(rows.select("_mx_source", "_mx_size"), weights,
                                         budget_ratio, max_epochs), "mix-targets")
    buckets = F.ceil(F.col("_mx_docs") / BUCKET_ROWS)
    # the high bits of the hash say which bucket: order by bucket, then hash, is hash order
    bucket = F.floor(F.col("_mx_hash") / float(1 << HASH_BITS) * buckets)

    def bucketed(df: DataFrame) -> DataFrame:
        # one small row per source: null sources meet through the null-safe key
        t = targets.select(*[F.col(c).alias(c if c != "_mx_source" else "_mx_key") for c in targets.columns])
        return (df.join(F.broadcast(t) if targets_fit else t, F.col("_mx_source").eqNullSafe(F.col("_mx_key")))
                .drop("_mx_key").withColumn("_mx_bucket", bucket))

    targets_fit = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    slim = bucketed(rows.select("_mx_source", "_mx_size", "_mx_hash"))
    totals = slim.groupBy("_mx_rank", "_mx_bucket").agg(F.sum("_mx_size").alias("_mx_sum"))
    earlier = W.partitionBy("_mx_rank").orderBy("_mx_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("_mx_rank", "_mx_bucket",
                           F.coalesce(F.sum("_mx_sum").over(earlier), F.lit(0)).alias("_mx_start"))
    inside = (W.partitionBy("_mx_rank", "_mx_bucket").orderBy("_mx_hash", id_col, "_mx_size", "_mx_text")
              .rowsBetween(W.unboundedPreceding, -1))
    at = bucketed(rows).withColumn("_mx_inside", F.coalesce(F.sum("_mx_size").over(inside), F.lit(0)))
    placed = at.join(starts, ["_mx_rank", "_mx_bucket"])
    begin = F.col("_mx_start") + F.col("_mx_inside")
    words, target, n = F.col("_mx_words"), F.col("_mx_target"), F.col("_mx_size")
    middle = begin + n / 2
    # copies whose middle lies before the target: epoch k holds the words [k, k+1) * words
    copies = F.when(words > 0, F.least(F.lit(math.ceil(max_epochs)), F.greatest(
        F.lit(0), F.ceil((target - middle) / words)))).otherwise(F.lit(0)).cast("int")
    copies = F.when(n > 0, copies).otherwise(F.lit(0))
    return placed.withColumns({"_mx_middle": middle, "_mx_copies": copies}).withColumns({
        "_mx_taken": F.col("_mx_copies") * n,
        "_mx_due": F.transform(
            F.when(F.col("_mx_copies") > 0, F.sequence(F.lit(0), F.col("_mx_copies") - 1)),
            lambda k: _due((F.col("_mx_middle") + k * words) / target, schedules))})


BROADCAST_SOURCES = 1000


def _due(share: Column, schedules: Sequence[Sequence[tuple[float, float]]]) -> Column:
    out = invert_schedule(share, schedules[0])
    for i, knots in enumerate(schedules[1:], 1):
        out = F.when(F.col("_mx_rank") % len(schedules) == i, invert_schedule(share, knots)).otherwise(out)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
        budget_ratio: float = 1.5, max_epochs: float = 2.0, seed: int = 17) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (words the
    mix takes, repeats counted), ``copies`` and ``positions`` (training time of each copy),
    sorted by first position; rows that are not taken come last.

    Null or empty texts have size 0 and are never taken; a null source is a source of its
    own, last in order. Equal rows are separate documents of the stream; a document is taken
    ``ceil(max_epochs)`` times at most. Input columns that
    bear the added names are replaced. No rows in, no rows out.
    """
    p = _placed(docs, id_col, text_col, source_col, weights, schedules, budget_ratio, max_epochs, seed)
    p = p.orderBy(F.element_at("_mx_due", 1).asc_nulls_last(), F.col("_mx_hash"), F.col(id_col), F.col("_mx_text"))
    return annotated(p, {"size": F.col("_mx_size"), "source_size": F.col("_mx_words"),
                         "target": F.col("_mx_target"), "taken": F.col("_mx_taken"),
                         "copies": F.col("_mx_copies"), "positions": F.col("_mx_due")}, docs.columns)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each taken copy a row with the columns of ``docs``, in training order."""
    names = {"id_col": "doc_id", "text_col": "text", "source_col": "source"}
    opts = {"weights": WEIGHTS, "schedules": SCHEDULES, "budget_ratio": 1.5, "max_epochs": 2.0,
            "seed": 17} | names | options
    p = _placed(docs, **opts).withColumn("_mx_at", F.explode("_mx_due"))
    return own(p.orderBy("_mx_at", "_mx_hash", opts["id_col"], "_mx_text"), docs.columns)
