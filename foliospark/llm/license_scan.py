"""License scan: exact seeds find candidates, bounded-error matching verifies them.

A phrase that occurs with at most k edits, cut into k + 1 pieces, has at least one piece without an
edit (pigeonhole). So one Aho-Corasick pass over a text's words finds every seed; only around
seeds is the phrase matched with the regex library's error bound, and only there are exact
places counted. Both see whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import struct_udf, word_finder


# Words of up to so many letters have to stand in a match as they are: one edit makes others of them.
SHORT_WORD = 4


@dataclass(frozen=True)
class Notice:
    """``words``: what to look for, lower case, single spaces. ``edits``: how many may differ, in
    words of more than ``SHORT_WORD`` letters."""

    label: str
    words: str
    edits: int


# The phrases whose exact places are counted, with their labels. Fixed values.
BASE = (
    Notice("mit", "mit license", 1),
    Notice("apache", "apache license", 1),
    Notice("gpl", "general public license", 2),
)

# Short notices that are looked for with errors. Their labels are the method's own.
NOTICES = (
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 4),
    Notice("mit", "released under the mit license", 3),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms with or without", 4),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("cc", "creative commons attribution", 2),
    Notice("isc", "permission to use copy modify and or distribute this software for any", 4),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 4),
    Notice("epl", "eclipse public license", 2),
)

SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
    " labels string, score double,"
    " spans array<struct<label:string,start:int,end:int,edits:int>>"
)


def seeds(words: str, edits: int) -> list[tuple[str, int]]:
    """``edits + 1`` pieces of about one length that make up ``words``, with their offsets."""
    n = edits + 1
    cuts = [round(i * len(words) / n) for i in range(n + 1)]
    return [(words[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]


def scanner(notices: tuple[Notice, ...], base: tuple[Notice, ...]):
    """The function of one text, with the automaton over all seeds built."""
    import re
    from bisect import bisect_right
    from itertools import accumulate

    import ahocorasick
    import regex

    every = (*base, *notices)
    places: dict[str, list[tuple[int, int]]] = {}
    for i, notice in enumerate(every):
        for piece, at in seeds(notice.words, notice.edits):
            places.setdefault(piece, []).append((i, at))
    automaton = ahocorasick.Automaton()
    for piece, found in places.items():
        automaton.add_word(piece, (len(piece), found))
    automaton.make_automaton()
    # The first match of fewest edits; a notice starts and ends with a word.
    fuzzy = [
        regex.compile(rf"(?<= )(?e)(?:{regex.escape(x.words, literal_spaces=True)}){{e<={x.edits}}}(?= )")
        for x in every
    ]
    short = [[w for w in x.words.split(" ") if len(w) <= SHORT_WORD] for x in every]

    def keeps_short_words(i: int, match: str) -> bool:
        words = iter(match.split(" "))
        return all(any(w == x for x in words) for w in short[i])

    find_words = word_finder()
    each_word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def windows(line: str) -> dict[int, list[list[int]]]:
        """For each notice the stretches of ``line`` that a match can touch, merged."""
        out: dict[int, list[list[int]]] = {}
        for end, (size, found) in automaton.iter(line):
            for i, at in found:
                x = every[i]
                start = max(0, end + 1 - size - at - x.edits - 1)
                stop = min(len(line), end + 1 - size - at + len(x.words) + x.edits + 1)
                out.setdefault(i, []).append([start, stop])
        for i, spans in out.items():
            spans.sort()
            merged = [spans[0]]
            for a, b in spans[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            out[i] = merged
        return out

    def one(text: str | None) -> tuple:
        words = find_words(text or "")
        line = f" {' '.join(words)} "
        exact: list[tuple[int, str]] = []
        close: dict[tuple[str, int, int], int] = {}
        score = 0.0
        for i, spans in windows(line).items():
            notice = every[i]
            for a, b in spans:
                if i < len(base):
                    phrase, at = f" {notice.words} ", line.find(f" {notice.words} ", a, b)
                    while at >= 0:
                        exact.append((at, notice.label))
                        at = line.find(phrase, at + 1, b)
                for m in fuzzy[i].finditer(line, a, b):
                    if not keeps_short_words(i, m.group()):
                        continue
                    edits = sum(m.fuzzy_counts)
                    key = (notice.label, m.start(), m.end())
                    close[key] = min(edits, close.get(key, edits))
                    score = max(score, 1 - edits / len(notice.words))
        if not exact and not close:
            return len(words), 0, None, None, "", "", 0.0, []
        # Where each word begins in the line, so that a place costs a look-up whatever the length.
        begins = list(accumulate((len(w) + 1 for w in words), initial=1))
        firsts = [bisect_right(begins, at + 1) - 1 for at, _ in exact]
        base_labels = {label for _, label in exact}
        spans = []
        if close:
            where = [m.span() for m in each_word.finditer(text)]
            for (label, a, b), edits in sorted(close.items(), key=lambda x: (x[0][1], x[0])):
                first, last = bisect_right(begins, a) - 1, bisect_right(begins, b - 1) - 1
                spans.append(
                    {
                        "label": label,
                        "start": where[first][0],
                        "end": where[last][1],
                        "edits": edits,
                    }
                )
        labels = base_labels | {label for label, _, _ in close}
        return (
            len(words),
            len(exact),
            min(firsts, default=None),
            max(firsts, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            score,
            spans,
        )

    return one


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    into: str = "licenses",
    notices: tuple[Notice, ...] = NOTICES,
    base: tuple[Notice, ...] = BASE,
) -> DataFrame:
    """``docs`` with a struct column ``into``: what ``SCHEMA`` lists, for each row.

    Narrow: one Arrow stage, no shuffle. A null or empty text has no words, no labels and score
    0. ``spans`` holds places in the original text, in code points, end exclusive; ``score`` is the best
    match's share of unedited characters. Repeated rows give repeated results, an empty table none. A text
    of any length is held by one task, as one line of its words. A table that has a column named as ``into`` is refused.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {into!r} already")
    found = struct_udf(lambda: scanner(notices, base), SCHEMA)
    return docs.withColumn(into, found(F.col(text_col)))
