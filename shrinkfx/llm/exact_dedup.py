"""Exact deduplication by progressive refinement.

Rows are grouped by byte length; rows whose length is shared, by the hash of a prefix;
rows that still share a group, by the hash of the whole text. The text is read once, into
thin rows (id, length, prefix hash, full hash); each pass counts its groups with
map-side partial aggregation and hands on only the members of groups of two or more, so
the widest key is grouped only where a copy is possible, and a group holding a third of
all rows is one counter in every task. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shrinkfx.llm.frames import annotated, own

PREFIX_CHARS = 256
#: A group's rows are dealt to so many tasks when they meet the group's key: one length, or one
#: text, may belong to a third of all rows. The key tables hold shared groups only.
SALTS = 16
_KEYS = ["_xd_len", "_xd_prefix", "_xd_full"]


def _keyed(docs: DataFrame, text_col: str, prefix_chars: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        "*", F.octet_length(text).alias("_xd_len"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_xd_prefix"),
        F.unhex(F.sha2(text, 256)).alias("_xd_full"))


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_xd_n")).where("_xd_n > 1").drop("_xd_n")


def _meet(rows: DataFrame, groups: DataFrame, keys: list[str], how: str, id_col: str) -> DataFrame:
    """Join rows to the table of groups by ``keys``, each group spread over ``SALTS`` tasks."""
    # rows without id go by their place in the scan, so that they are spread as well
    name = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(F.col(id_col), F.lit("salt")))
    salted = rows.withColumn("_xd_salt", F.pmod(name, F.lit(SALTS)).cast("int"))
    spread = groups.withColumn("_xd_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [*keys, "_xd_salt"], how).drop("_xd_salt")


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per group of two or more equal texts: its refinement keys, ``_xd_keep``
    (largest id), ``_xd_size`` and ``_xd_top`` (rows that bear the largest id)."""
    thin = _keyed(docs.select(F.col(id_col).alias("_xd_id"), F.col(text_col).alias("_xd_text")),
                  "_xd_text", prefix_chars).drop("_xd_text")
    same_length = _meet(thin, _shared(thin, _KEYS[:1]), _KEYS[:1], "left_semi", "_xd_id")
    same_prefix = _meet(same_length, _shared(same_length, _KEYS[:2]), _KEYS[:2], "left_semi", "_xd_id")
    by_id = same_prefix.groupBy(*_KEYS, "_xd_id").agg(F.count(F.lit(1)).alias("_xd_rows"))
    return (by_id.groupBy(*_KEYS)
            .agg(F.max(F.struct(F.col("_xd_id").isNotNull(), "_xd_id", "_xd_rows")).alias("_xd_best"),
                 F.sum("_xd_rows").alias("_xd_size"))
            .where("_xd_size > 1")
            .select(*_KEYS, F.col("_xd_best._xd_id").alias("_xd_keep"), "_xd_size",
                    F.col("_xd_best._xd_rows").alias("_xd_top")))


def _judged(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    groups = copy_groups(docs, id_col, text_col, prefix_chars)
    rows = _meet(_keyed(docs, text_col, prefix_chars), groups, _KEYS, "left", id_col)
    alone = F.col("_xd_size").isNull()
    return rows.withColumns({
        "_xd_keep": F.when(alone, F.col(id_col)).otherwise(F.col("_xd_keep")),
        "_xd_size": F.coalesce("_xd_size", F.lit(1)),
        "_xd_kept": alone | F.col(id_col).eqNullSafe(F.col("_xd_keep"))})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The row with the largest id of each group stays. Null text equals empty text. Rows
    repeated in id and text count in ``group_size`` and share one verdict (``keep_first``
    leaves one of them). A null id loses to any other; a group of null ids keeps its
    rows. Input columns that bear the added names are replaced. No rows in, no rows out.
    """
    j = _judged(docs, id_col, text_col, prefix_chars)
    return annotated(j, {"keep_id": F.col("_xd_keep"), "group_size": F.col("_xd_size"),
                         "kept": F.col("_xd_kept"),
                         "text_sha256": F.lower(F.hex("_xd_full"))}, docs.columns)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows that stay, one per distinct text, with the columns of ``docs`` as they
    were. Only groups whose largest id is borne by several rows need the second step."""
    kept = _judged(docs, id_col, text_col, prefix_chars).where("_xd_kept")
    once = kept.where(F.coalesce("_xd_top", F.lit(1)) == 1)
    repeated = kept.where(F.col("_xd_top") > 1).dropDuplicates(_KEYS)
    return own(once, docs.columns).unionByName(own(repeated, docs.columns))
