"""Chat formatting: every assistant turn is an example of its own, with all turns before it as context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """``text`` without control strings: each ``<|``, even one escaped before, gets one more backslash inside."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role ends with its line, so line feeds and percent signs become codes."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def prefix_examples(turns: DataFrame) -> DataFrame:
    """Examples of ``conv_id``: ``example`` (from 0), ``text``, ``loss_start`` and ``loss_length``.

    A turn is formatted as ``<|im_start|>role``, a line feed, the text and ``<|im_end|>`` with a line feed, and
    control strings inside roles and texts are escaped. Each assistant turn gives an example that ends with it;
    only its text, without the markers, is under the loss mask: ``loss_length`` characters from ``loss_start``
    (from 0). Turns after the last assistant turn are in a last example without loss (both null), so that the
    longest example always has the whole conversation.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are left out. Rows go by turn,
    null first, and equal turns by role and text. Null texts and roles are empty. Null ``conv_id`` is a
    conversation too. An empty table gives an empty result. A conversation is one row while it is formatted,
    as its longest example is one.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    line = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    formatted = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n"))
    spans = (
        rows.withColumn("formatted", formatted)
        .withColumn("end", F.sum(F.length("formatted")).over(line))
        .select("conv_id", F.struct("end", F.length(escape(F.col("text"))).cast("bigint").alias("length"), "role", "formatted").alias("span"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
        .select("conv_id", "spans", F.array_join("spans.formatted", "").alias("whole"))
    )
    last = F.element_at("spans", -1)
    tail = F.when(last["role"] != ASSISTANT, F.array(F.struct(last["end"].alias("end"), F.lit(None).cast("bigint").alias("length"))))
    replies = F.transform(F.filter("spans", lambda s: s["role"] == ASSISTANT), lambda s: F.struct(s["end"].alias("end"), s["length"].alias("length")))
    cuts = F.concat(replies, F.coalesce(tail, F.array().cast("array<struct<end:bigint,length:bigint>>")))
    exploded = spans.select("conv_id", "whole", F.posexplode(cuts).alias("example", "cut"))
    return exploded.select(
        "conv_id",
        "example",
        F.substring("whole", F.lit(1), F.col("cut.end").cast("int")).alias("text"),
        (F.col("cut.end") - (len(END) + 1) - F.col("cut.length")).alias("loss_start"),
        F.col("cut.length").alias("loss_length"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as structs of ``role`` and ``text``."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p.startswith(START))
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substring(p, len(START) + 1, 2**31 - 1), "\n", 1)).alias("role"),
            unescape(F.regexp_replace(p, r"\A[^\n]*\n", "")).alias("text"),
        ),
    )


def loss_text(example: DataFrame) -> Column:
    """The text under an example's loss mask, as it was before formatting; null without loss."""
    return unescape(F.substring(example["text"], (example["loss_start"] + 1).cast("int"), example["loss_length"].cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of each conversation, from its examples alone: see the columns."""
    longest = F.max_by("text", F.length("text"))
    replies = F.sort_array(F.collect_list(F.struct("example", "reply")))
    found = (
        examples.withColumn("reply", loss_text(examples))
        .groupBy("conv_id")
        .agg(longest.alias("longest"), replies.alias("replies"), F.sum(F.length("text")).alias("formatted_chars"))
    )
    read = found.select(
        "conv_id", "formatted_chars", read_turns(F.col("longest")).alias("turns"), F.array_join("replies.reply", "").alias("loss")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
