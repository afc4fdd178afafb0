"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role become one
block; blocks are concatenated into one string. Control strings inside texts are escaped, so the
formatted string can be taken apart again. Every step is linear in the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of the template. None of them can stand in an escaped text, as all contain "<|".
START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
# A line break inside a role; the role ends at the first line break.
ROLE_BREAK = r"<\/>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    r"""Doubles every backslash and turns ``<|`` into ``<\|``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    r"""Undoes :func:`escape`: a lone backslash stands in ``<\|`` only, all others in pairs."""
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(ROLE_BREAK))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(ROLE_BREAK), F.lit("\n")))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned_role: str = LEARNED_ROLE,
) -> DataFrame:
    """(conv_id, formatted, segments), one row per conversation.

    ``segments`` are the stretches of ``formatted`` in order, each with its text and whether it
    counts in the loss: the texts of ``learned_role``, without any mark. Turns are ordered by
    number, then role and text, so ties have one order; a null number comes first. A null role or text is the empty
    string; repeated rows are turns of their own; rows of a null conversation are one conversation. Adjacent
    turns of one role share a block, parted by a mark.

    The result is one string per conversation, so a conversation passes through one task; its size
    is a row's, and texts cross one shuffle.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    collected = (
        turns.select(
            F.col(conv_col).alias("conv_id"),
            F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    n = F.size("turns")

    def role_at(i: Column) -> Column:
        return F.element_at("turns", i + 1)["role"]

    # The first turn of each block, then each block as a slice of the turns.
    firsts = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role_at(i) != role_at(F.greatest(i - 1, F.lit(0))))
    )
    blocks = F.transform(
        "firsts",
        lambda first, k: F.struct(
            role_at(first).alias("role"),
            F.slice(
                "turns", first + 1, F.coalesce(F.get("firsts", k + 1), F.size("turns")) - first
            ).alias("turns"),
        ),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def block_segments(block: Column) -> Column:
        learned = block["role"] == learned_role
        head = F.array(
            segment(F.concat(F.lit(START), escape_role(block["role"]), F.lit("\n")), F.lit(False))
        )
        body = F.flatten(
            F.transform(
                block["turns"],
                lambda t, i: F.when(
                    i > 0,
                    F.array(
                        segment(F.lit(NEXT), F.lit(False)), segment(escape(t["text"]), learned)
                    ),
                ).otherwise(F.array(segment(escape(t["text"]), learned))),
            )
        )
        return F.concat(head, body, F.array(segment(F.lit(END), F.lit(False))))

    segments = F.flatten(F.transform("blocks", block_segments))
    return (
        collected.withColumn("firsts", firsts)
        .withColumn("blocks", blocks)
        .select("conv_id", segments.alias("segments"))
        .select(
            "conv_id",
            F.array_join(F.col("segments")["text"], "").alias("formatted"),
            "segments",
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns, as (role, text) structs, of a formatted conversation."""
    blocks = F.filter(F.split(formatted, "<\\|im_end\\|>\n", -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substr(b, F.locate("\n", b) + 1), "<\\|im_next\\|>", -1),
                lambda t: F.struct(
                    unescape_role(
                        F.substr(b, F.lit(len(START) + 1), F.locate("\n", b) - len(START) - 1)
                    ).alias("role"),
                    unescape(t).alias("text"),
                ),
            ),
        )
    )


def learned_text(segments: Column) -> Column:
    """All text that counts in the loss, as it stood in the turns."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"])), "")
