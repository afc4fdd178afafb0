"""Column functions on text: strip, blank test, paragraphs, greedy packing, requests."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark import constants as K

# Paragraphs per block of the packing fold.
_BLOCK = 1024


def strip(text: Column) -> Column:
    """Python's ``str.strip()``; Spark's plain ``trim`` removes spaces only."""
    return F.btrim(text, F.lit(K.WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return text.isNull() | (F.ltrim(text, F.lit(K.WHITESPACE)) == "")


def without_bom(text: Column) -> Column:
    return F.when(text.startswith(K.BYTE_ORDER_MARK), F.substr(text, F.lit(2))).otherwise(text)


def split_literal(text: Column, separator: str) -> Column:
    """Split on exactly ``separator``, keeping empty parts."""
    return F.split(text, re.escape(separator), -1)


def language_suffix(lang: Column) -> Column:
    entries = [F.lit(x) for pair in K.LANGUAGE_SUFFIX.items() for x in pair]
    return F.coalesce(
        F.try_element_at(F.create_map(*entries), lang), F.lit(K.OTHER_LANGUAGE_SUFFIX)
    )


def chunk_starts(lengths: Column, max_chars: int) -> Column:
    """1-based index of the first paragraph of every chunk, by ordered greedy packing.

    ``lengths`` are the paragraph lengths in characters. A paragraph opens a new chunk when it
    would take the running length over ``max_chars``. Only paragraph characters count, separators
    do not, and no paragraph is ever split. The running length restarts at data-dependent places,
    so this is a fold and not a window.

    ``aggregate`` copies its state at every step. The paragraphs are therefore folded in blocks:
    the inner fold's state holds the starts of one block only, and the outer one is copied once
    per block, so that a document of a million paragraphs still packs in seconds.
    """
    n = F.size(lengths)
    no_starts = F.array().cast("array<int>")

    def fold_block(done: Column, block: Column) -> Column:
        first = block * _BLOCK + 1

        def step(state: Column, i: Column) -> Column:
            length = F.get(lengths, i - 1)
            opens = (i == 1) | (state["length"] + length > max_chars)
            return F.struct(
                F.when(opens, length).otherwise(state["length"] + length).alias("length"),
                F.when(opens, F.array_append(state["starts"], i))
                .otherwise(state["starts"])
                .alias("starts"),
            )

        return F.aggregate(
            F.sequence(first, F.least(first + (_BLOCK - 1), n)),
            F.struct(done["length"].alias("length"), no_starts.alias("starts")),
            step,
            lambda state: F.struct(
                state["length"].alias("length"),
                F.array_append(done["blocks"], state["starts"]).alias("blocks"),
            ),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
        F.struct(
            F.lit(0).alias("length"), F.array().cast("array<array<int>>").alias("blocks")
        ),
        fold_block,
        lambda done: F.flatten(done["blocks"]),
    )


def join_slices(paragraphs: Column, starts: Column, separator: str) -> Column:
    """Chunk texts from the paragraphs and the start offsets of :func:`chunk_starts`.

    Paragraphs are picked by index: ``slice`` would copy the whole paragraph array per chunk.
    """

    def chunk(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1) - 1, F.size(paragraphs))
        return F.array_join(
            F.transform(F.sequence(start, end), lambda i: F.get(paragraphs, i - 1)), separator
        )

    return F.transform(starts, chunk)


def system_prompt(template: str, target_lang: Column | str) -> Column:
    if isinstance(target_lang, str):
        return F.lit(template.replace("{target_lang}", target_lang))
    head, tail = template.split("{target_lang}")
    return F.concat(F.lit(head), target_lang, F.lit(tail))


def chat_request(
    text: Column, prompt: Column, model: str, temperature: float = K.TEMPERATURE
) -> Column:
    """One chat request as a struct, ready for ``to_json`` or for a user's client."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", prompt), message("user", text)).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
    )
