"""Chat formatting by prefix-target expansion: one example for each assistant turn, built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A turn is OPEN + role + CLOSE + text + END. Each of \ < [ in a text (in a role | too) is followed by a backslash, so no
#: control string of this or another common template (<s>, </s>, [INST], [/INST], <<SYS>>, <|...|>) stays whole in it.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", r"$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\<\[|])", r"$1\\")


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\<\[|])\\", r"$1")


def expand_conversations(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, target, formatted, loss_start, loss_end): an example for every turn of ``target_role``.

    Its text holds all turns up to that one; only that reply, [loss_start, loss_end) in code points, is trainable.
    Turns after the last such reply (or all, where there is none) stand in one further example without a target
    (target null, an empty mask), so nothing of a conversation is lost. Turns are ordered by turn (null first), then
    role, then text; a null role or text is empty; rows with a null conv_id are one conversation; repeated rows are
    turns of their own; other columns are not read. One shuffle, by conversation: a conversation's turns and its examples,
    which repeat all earlier turns, are one task's work, so one conversation must stay within a row (2 GB; with n replies
    its examples hold about n / 2 times its text).
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # array_sort puts structs with a null turn first
    heads = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(CLOSE)))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    is_target = F.transform("turns", lambda t: t["role"] == target_role)
    n = F.size("turns")
    laid = turns.select(
        "conv_id",
        is_target.alias("is_target"),
        heads.alias("heads"),
        bodies.alias("bodies"),
        F.arrays_zip(heads.alias("h"), bodies.alias("b")).alias("parts"),
        n.alias("n"),
    ).withColumn("pieces", F.transform("parts", lambda p: F.concat(p["h"], p["b"], F.lit(END)))).drop("parts")
    at = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.element_at("is_target", i) | (i == F.col("n")))
    each = laid.select("*", F.posexplode(at).alias("example", "last"))
    trainable = F.element_at("is_target", F.col("last"))
    formatted = F.array_join(F.slice("pieces", 1, F.col("last")), "")
    each = each.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.when(trainable, F.col("last") - 1).cast("long").alias("target"),
        formatted.alias("formatted"),
        F.char_length(F.element_at("bodies", F.col("last"))).alias("body"),
    )
    end = F.char_length("formatted") - len(END)
    return each.select(
        "conv_id", "example", "target", "formatted",
        F.when(F.col("target").isNotNull(), end - F.col("body")).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("target").isNotNull(), end).otherwise(0).cast("long").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> that a formatted text holds."""
    parts = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(p.substr(F.lit(len(OPEN) + 1), F.locate(CLOSE, p) - len(OPEN) - 1)).alias("role"),
            unescape(p.substr(F.locate(CLOSE, p) + len(CLOSE), F.char_length(p))).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """One row for each conversation, read from its examples alone: turns, text under the loss mask in order, characters."""
    masked = unescape(F.col("formatted").substr(F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = examples.select(
        "conv_id",
        F.struct(F.col("example"), masked.alias("masked")).alias("loss"),
        F.struct(F.col("example"), F.col("formatted")).alias("text"),
        F.char_length("formatted").cast("long").alias("chars"),
    ).groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("loss")), lambda x: x["masked"]), "").alias("loss"),
        F.max("text").alias("last"),
        F.sum("chars").alias("formatted_chars"),
    )
    return per.select("conv_id", read_turns(F.col("last.formatted")).alias("turns"), "loss", "formatted_chars")
