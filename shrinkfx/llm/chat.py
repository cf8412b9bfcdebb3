"""Relational chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and written in one
array pass: a turn opens a block unless the turn before has the same role (then it joins
that block after a separator) and closes it unless the turn after has the same role.
``array_join`` concatenates the pieces. Control strings inside texts are escaped by one
backslash between ``<`` and ``|``, which reading takes away again.

A conversation is one training example and is held in one row; conversations are spread
by id, and nothing wider than one conversation meets in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, JOIN, LINE = "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|nl|>"


def escape(text: Column) -> Column:
    """Every ``<``, backslashes, ``|`` gets one backslash more: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``segments``, an array of
    (text, loss) whose texts concatenate to ``formatted``; loss marks what is trained on.

    Null role or text is empty. Turns sort by number (null first), equal numbers by role,
    then text, and repeated rows stay repeated turns. A row without conversation id is a
    conversation of its own, so no number of them meets in one row. Other columns are
    ignored; no rows in, no rows out.
    """
    empty = F.lit("")
    alone = F.when(F.col(conv_col).isNull(), F.monotonically_increasing_id())
    rows = turns.select(F.col(conv_col).alias("conv_id"), alone.alias("alone"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    ts, n = F.col("ts"), F.size("ts")

    def block(t: Column, i: Column) -> Column:
        joins = (i > 0) & (F.get(ts, i - 1)["role"] == t["role"])
        ends = (i == n - 1) | (F.get(ts, i + 1)["role"] != t["role"])
        head = F.when(joins, F.lit(JOIN)).otherwise(
            F.concat(F.lit(START), _role(t["role"]), F.lit("\n")))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss")),
            F.struct(F.when(ends, F.lit(END + "\n")).otherwise(empty).alias("text"),
                     F.lit(False).alias("loss")))

    segments = F.flatten(F.transform(ts, block))
    return (chats.select("conv_id", segments.alias("segments"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "segments"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, in order."""
    blocks = F.split(formatted, r"<\|im_end\|>\n", -1)
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescape(F.replace(F.substr(head, F.lit(len(START) + 1)), F.lit(LINE), F.lit("\n")))
        body = F.substr(block, F.length(head) + 2)
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda x: F.struct(
            role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame) -> DataFrame:
    """What a formatted conversation holds, read back from ``formatted`` and ``segments``."""
    turns = read_turns(F.col("formatted"))
    joined = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (chats.withColumns({"_turns": turns, "_loss": loss_text(F.col("segments"))})
            .select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                    F.sha2(joined, 256).alias("turns_sha256"),
                    F.length("_loss").cast("long").alias("loss_chars"),
                    F.sha2("_loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
