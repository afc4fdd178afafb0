"""Secret scan: keyword prefilter, anchored expressions near hits, checksum validation.

One Aho-Corasick pass over the lower-cased text finds the keywords of all rules; a rule's
expression is then tried only at the places of its keywords. Token formats with an embedded
checksum are kept only if the checksum is right. Runs of hex digits have no keyword; their own
expression is anchored at the start of each run.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import lower_ascii, struct_udf

# Kinds whose matches are counted, in the order in which they are listed. Fixed values.
BASE_KINDS = ("assign", "access", "hex")
# Kinds of the method's own: tokens that end in six base-62 digits of the CRC-32 of what stands
# between prefix and checksum.
CHECKED_KINDS = ("github", "npm")
KINDS = BASE_KINDS + CHECKED_KINDS

ASSIGN = (
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = (
    "n_assign bigint, n_access bigint, n_hex bigint,"
    " spans array<struct<kind:string,start:int,end:int>>"
)


def crc32_base62(body: str) -> str:
    """The CRC-32 of ``body`` as six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def finder():
    """The function of one text: its (start, rank of kind, end), sorted."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, keywords in KEYWORDS.items():
        for word in keywords:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    expressions = {
        "assign": re.compile(ASSIGN, re.ASCII | re.IGNORECASE),
        "access": re.compile(r"AKIA[A-Z0-9]+"),
        "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
        "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    }
    # A run is found at its first digit or not at all, so shorter runs need not be looked at.
    hex_run = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")
    holds = {
        "assign": lambda m: m.end(2) - m.start(2) >= MIN_VALUE,
        "access": lambda m: m.end() - m.start() >= MIN_ACCESS,
        "github": lambda m: crc32_base62(m[1]) == m[2],
        "npm": lambda m: crc32_base62(m[1]) == m[2],
    }
    rank = {kind: i for i, kind in enumerate(KINDS)}

    def one(text: str) -> list[tuple[int, int, int]]:
        spans = [(m.start(), rank["hex"], m.end()) for m in hex_run.finditer(text)]
        # A match uses up its characters for its kind, also where it is dropped.
        used = dict.fromkeys(KEYWORDS, 0)
        near: dict[str, list[int]] = {kind: [] for kind in KEYWORDS}
        for end, (kind, size) in automaton.iter(lower_ascii(text)):
            near[kind].append(end + 1 - size)
        for kind, starts in near.items():
            for start in sorted(starts):
                if start >= used[kind] and (m := expressions[kind].match(text, start)):
                    used[kind] = m.end()
                    if holds[kind](m):
                        spans.append((start, rank[kind], m.end()))
        return sorted(spans)

    return one


def scanner():
    find = finder()

    def one(text: str | None) -> tuple:
        spans = find(text or "")
        counts = [0] * len(KINDS)
        for _, kind, _ in spans:
            counts[kind] += 1
        listed = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
        return *counts[: len(BASE_KINDS)], listed

    return one


def redactor(mark: str):
    find = finder()

    def one(text: str | None) -> tuple:
        if not text:
            return text, 0
        out, at, n = [], 0, 0
        for start, _, end in find(text):
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mark]
                n += 1
            at = end
        return "".join([*out, text[at:]]), n

    return one


def find_secrets(docs: DataFrame, text_col: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with a struct column ``into``: counts per base kind and all spans, for each row.

    Spans are in code points, end exclusive, sorted by start and kind. A null or empty text has
    none. Narrow: no shuffle; repeated rows give repeated results.
    """
    return docs.withColumn(into, struct_udf(scanner, SCHEMA)(F.col(text_col)))


def redact_secrets(
    docs: DataFrame, text_col: str = "text", into: str = "redacted", mark: str = "<SECRET>"
) -> DataFrame:
    """``docs`` with a struct column ``into`` of ``text``, in which ``mark`` stands for each
    secret (overlapping ones together), and ``n``, their number. A null text stays null."""
    cleaned = struct_udf(lambda: redactor(mark), "text string, n bigint")
    return docs.withColumn(into, cleaned(F.col(text_col)))
