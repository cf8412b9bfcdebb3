"""Reproducible stratified hold-out split, closing and move-back.

``stratified_split`` marks ``ceil(p * n_s)`` rows of every stratum ``s`` as
test: the rows that come first in the order ``md5(seed-key...)``, then the
tie columns. That is a deterministic stand-in for sampling without
replacement inside each stratum.

The flag is a plain comparison on the row, ``(hash, ties) <= last``, where ``last``
is the last held-out row's (hash, ties) of the row's stratum. ``split_rule`` finds it
(no task ever holds a whole stratum, even one with a third of the rows):

1. Histogram: count rows per (stratum, md5 prefix) -- a partial aggregate with at
   most ``strata * 16^BUCKET_HEX_DIGITS`` groups, whatever the number of rows.
2. On that small table, a running count per stratum finds the prefix bucket
   where the ``ceil(p * n_s)``-th row falls and how many rows of that bucket
   are still needed.
3. Only that bucket's rows (1 / 65,536 of a stratum) are ranked, and the one row with
   the needed rank is fetched per stratum.

Strata: ``by="value"`` uses each distinct value of ``y``; ``by="quartile"``
cuts ``y`` at its distinct quartile breaks, right-closed with the lowest value
included (the grouping of a numeric outcome in createDataPartition-style
splits). The breaks are exact: values are counted first, so the outcome should
have few distinct values, as ratings do.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shrinkfx.operators.keys import key_registry, key_text
from shrinkfx.session import materialize

BUCKET_HEX_DIGITS = 4

_H, _S, _B = "__split_hash", "__stratum", "__bucket"


def split_hash(seed, hash_keys: Sequence[str]) -> Column:
    """The 16 bytes by which rows are ordered inside a stratum."""
    return F.unhex(F.md5(F.concat_ws("-", F.lit(str(seed)),
                                     *[F.col(k).cast("string") for k in hash_keys])))


def _stratum(df: DataFrame, y: str, by: str) -> Column:
    """The stratum of a row; quartile breaks come from the counts of distinct values."""
    c = F.col(y)
    if by == "value":
        return c
    if by != "quartile":
        raise ValueError(f"unknown strata mode {by!r}")
    counted = df.where(c.isNotNull()).groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    st = counted.agg(F.expr("percentile(v, array(0.25, 0.5, 0.75), c)").alias("q"), F.min("v").alias("lo")).first()
    if st["lo"] is None:
        return F.lit(0)
    # interval index = number of distinct interior breaks strictly below the value
    idx = F.lit(0)
    for q in st["q"]:
        if float(q) > float(st["lo"]):
            idx = idx + F.when(c > F.lit(float(q)), 1).otherwise(0)
    return F.when(c.isNull(), F.lit(None)).otherwise(idx)


def split_rule(df: DataFrame, y: str = "rating", p: float = 0.1, seed="1", hash_keys: Sequence[str] = (),
               tie_keys: Sequence[str] = (), by: str = "quartile", hashed: str | None = None) -> Column:
    """The boolean column that is true on the held-out rows of ``df``.

    ``df`` is read three times (breaks, histogram, boundary rows); pass a stored table.
    One row per stratum comes to the driver: strata should be few. Rows that agree in hash
    keys and ties are held out together. ``hashed`` names a column that already holds
    ``split_hash(seed, hash_keys)``; then no scan computes it again."""
    stratum, h = _stratum(df, y, by), F.col(hashed) if hashed else split_hash(seed, hash_keys)
    place = F.struct(h.alias(_H), *[F.col(k) for k in tie_keys])
    bucket = F.conv(F.substring(F.hex(F.substring(h, 1, 8)), 1, BUCKET_HEX_DIGITS), 16, 10).cast("long")
    base = df.select(stratum.alias(_S), bucket.alias(_B), place.alias("__place"))
    counts = base.groupBy(_S, _B).agg(F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy(_S).orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(_S)
    cut = (counts
           .withColumn("cum", F.sum("c").over(run))
           .withColumn("k", F.ceil(F.lit(float(p)) * F.sum("c").over(whole)).cast("long"))
           .filter((F.col("cum") - F.col("c") < F.col("k")) & (F.col("k") <= F.col("cum")))
           .select(F.col(_S).alias("__cut_s"), F.col(_B).alias("__cut_b"),
                   (F.col("k") - (F.col("cum") - F.col("c"))).alias("__need")))
    cut = materialize(cut, "split_cut")  # one row per stratum
    at_cut = base.join(F.broadcast(cut), base[_S].eqNullSafe(cut["__cut_s"]) & (base[_B] == cut["__cut_b"]))
    ranked = at_cut.withColumn("rank", F.row_number().over(Window.partitionBy(_S).orderBy("__place")))
    last = ranked.where(F.col("rank") == F.col("__need")).select(_S, "__place").collect()
    kinds = {f.name: f.dataType for f in df.select(*tie_keys).schema.fields} if tie_keys else {}
    flag = F.lit(False)
    for row in last:
        values = [F.lit(bytes(row["__place"][_H])).alias(_H)] + [
            F.lit(row["__place"][k]).cast(kinds[k]).alias(k) for k in tie_keys]
        flag = F.when(stratum.eqNullSafe(F.lit(row[_S])), place <= F.struct(*values)).otherwise(flag)
    return flag


def stratified_split(df: DataFrame, y: str = "rating", p: float = 0.1, seed="1",
                     hash_keys: Sequence[str] = (), tie_keys: Sequence[str] = (),
                     by: str = "quartile", flag: str = "is_test") -> DataFrame:
    """Return ``df`` with a boolean ``flag`` column (True = held out): one scan of ``df``."""
    return df.withColumn(flag, split_rule(df, y, p, seed, hash_keys, tie_keys, by))


def unseen_keys(flagged: DataFrame, keys: Sequence[str], flag: str = "is_test") -> DataFrame:
    """``(kind, key)`` of the key values that only held-out rows have, for all ``keys`` in
    one scan and one aggregate (combined map-side). ``kind`` is the key's place in ``keys``.

    The table is written, and later joins read it alone: a key that occurs but once in the
    kept rows is not in it, so it has at most a row per held-out row and key."""
    seen = key_registry(flagged, keys, flag).groupBy("kind", "key").agg(F.every(flag).alias("held"))
    return materialize(seen.where("held").select("kind", "key"), "unseen_keys")


def _unseen(unseen: DataFrame, kind: int, name: str) -> DataFrame:
    return unseen.where(F.col("kind") == kind).select(F.col("key").alias(name))


def keep_seen(held: DataFrame, unseen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Held-out rows none of whose keys is in ``unseen`` (null keys count as values)."""
    for i, k in enumerate(keys):
        held = held.join(_unseen(unseen, i, f"__u{i}"), key_text(k) == F.col(f"__u{i}"), "left_anti")
    return held


def close_holdout(test: DataFrame, train: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep test rows whose value of every key occurs in train: each side is scanned once
    for all keys, then the rows meet the few values that train lacks."""
    both = (test.select(*keys, F.lit(True).alias("__held"))
            .unionByName(train.select(*keys, F.lit(False).alias("__held"))))
    return keep_seen(test, unseen_keys(both, keys, "__held"), keys)


@dataclass
class HoldOut:
    train: DataFrame       # kept rows plus the held-out rows moved back
    holdout: DataFrame     # held-out rows whose keys all occur in train
    moved_back: DataFrame  # held-out rows with an unknown key
    tagged: DataFrame      # held-out rows with ``known`` (True = stays held out)


def split_with_return(flagged: DataFrame, keys: Sequence[str], flag: str = "is_test") -> HoldOut:
    """Close the hold-out on ``keys`` and move the rows it loses back to training.

    Each held-out row is tagged once against the key values that only held-out rows have
    (``unseen_keys``, one scan for all keys); the closed hold-out and the moved-back rows are
    two filters of that tagged frame (no all-column anti join needed, and equal to one
    because identical rows get identical tags).
    """
    kept = flagged.filter(~F.col(flag)).drop(flag)
    tagged = flagged.filter(F.col(flag)).drop(flag)
    unseen = unseen_keys(flagged, keys, flag)
    known = F.lit(True)
    for i, k in enumerate(keys):
        tagged = tagged.join(_unseen(unseen, i, f"__u{i}"), key_text(k) == F.col(f"__u{i}"), "left")
        known = known & F.col(f"__u{i}").isNull()
    tagged = tagged.withColumn("known", known).drop(*[f"__u{i}" for i in range(len(keys))])
    return from_tagged(kept, tagged)


def from_tagged(kept: DataFrame, tagged: DataFrame) -> HoldOut:
    """Build the three outputs from a (possibly stored) tagged hold-out."""
    holdout = tagged.filter(F.col("known")).drop("known")
    back = tagged.filter(~F.col("known")).drop("known")
    return HoldOut(train=kept.unionByName(back), holdout=holdout, moved_back=back, tagged=tagged)
