r"""Personal data, with Spark expressions only.

Expressions propose spans, checksums confirm them, words around a span adjust its score.

Every expression is the plain one it is named after, rewritten so that Java's matcher neither
recurses nor tries a long run again and again: repetitions give nothing back, a run is tried at
its first character or where the match before it ended (\G), and runs that cannot have enough
digits are not matched. The matches are the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distance from a span in which context words count in full and by half, in characters, and how much
# of the text on each side is looked at: the longest word and its neighbour more.
NEAR, FAR, SEEN = 15, 40, 64
# Words that speak for a number of another kind.
OTHER = ("version", "release", "section", "figure", "page", "chapter", "isbn", "serial")
BLOCK = 64


@dataclass(frozen=True)
class Kind:
    """``score`` without context words. One of ``context`` adds ``lift`` and one of ``against`` takes it
    away, as whole words in any case, before or behind; half of it from farther off."""

    name: str
    pattern: str
    needs: str  # no match without this expression in the text
    score: float
    context: tuple[str, ...]
    lift: float = 0.3
    against: tuple[str, ...] = OTHER


EMAIL = Kind(
    "email",
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "@",
    0.7,
    ("mail", "mails", "email", "emails", "contact", "write"),
)
IP = Kind(
    "ip",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9]\.[0-9]",
    0.6,
    ("ip", "ipv4", "address", "addresses", "host", "server"),
)
CARD = Kind(
    "card",
    r"[0-9](?:[\x20-]?[0-9]){15,}+",
    r"[0-9](?:[\x20-]?[0-9]){15}",
    0.5,
    ("card", "cards", "visa", "mastercard", "credit", "payment"),
)
PHONE = Kind(
    "phone",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"\+[0-9]",
    0.5,
    ("phone", "telephone", "tel", "call", "mobile", "fax"),
)
# The method's own kind; two letters, two check digits, up to 30 more characters, mod 97.
IBAN = Kind(
    "iban",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}",
    0.6,
    ("iban", "account", "bank"),
)
BASE_KINDS = (EMAIL, IP, CARD, PHONE)
KINDS = (*BASE_KINDS, IBAN)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + value(i)
    )
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """The remainder of an account code, its first four characters moved to the end and letters
    read as 10 to 35."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def step(r: Column, i: Column) -> Column:
        c = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(c >= 65, (r * 100 + c - 55) % 97).otherwise((r * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step)


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        # A part may be longer than any number type; without leading zeros it has three digits.
        return F.forall(
            F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")).rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
        )
    if kind == "card":
        digits = digits_of(match)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(match)).between(8, 15)
    if kind == "iban":
        return mod97(match) == 1
    return F.lit(True)


def sum_before(sizes: Column, sums: Column, k: Column) -> Column:
    """The sum of the first ``k`` of ``sizes``; ``sums`` holds the sums before each block."""
    block = F.floor(k / BLOCK).cast("int")
    rest = F.slice(sizes, block * BLOCK + 1, k % BLOCK)
    return F.get(sums, block) + F.aggregate(rest, F.lit(0), lambda a, x: a + x)


def block_sums(sizes: Column) -> Column:
    blocks = F.sequence(F.lit(0), F.floor(F.size(sizes) / BLOCK).cast("int"))
    each = F.transform(
        blocks,
        lambda b: F.aggregate(F.slice(sizes, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x),
    )
    return F.transform(
        blocks, lambda b: F.aggregate(F.slice(each, 1, b), F.lit(0), lambda a, x: a + x)
    )


def sizes_of(name: str) -> Column:
    """Characters of each match and the gap before it."""
    gaps = F.col(f"{name}_g")
    return F.transform(f"{name}_m", lambda x, i: F.length(F.get(gaps, i)) + F.length(x))


def stands_near(words: tuple[str, ...], before: Column, behind: Column, distance: int) -> Column:
    """Whether one of ``words`` ends or begins within ``distance`` characters of a span."""
    whole = f"(?<![A-Za-z])(?:{'|'.join(words)})(?![A-Za-z])"
    gap = f"(?s:.{{0,{distance}}})"
    return before.rlike(f"(?i){whole}{gap}$") | behind.rlike(f"(?i)^{gap}{whole}")


def context_score(kind: Kind, before: Column, behind: Column) -> Column:
    def weight(words: tuple[str, ...]) -> Column:
        near = F.when(stands_near(words, before, behind, NEAR), 1.0)
        return near.when(stands_near(words, before, behind, FAR), 0.5).otherwise(0.0)

    change = weight(kind.context) - weight(kind.against)
    score = F.round(F.lit(kind.score) + kind.lift * change, 6)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))


def spans_of(kind: Kind) -> Column:
    """The confirmed matches of ``kind`` with their places and scores."""
    gaps, sizes, sums = (F.col(f"{kind.name}_{x}") for x in "gsb")

    def span(x: Column) -> Column:
        gap = F.get(gaps, x["i"])
        start = sum_before(sizes, sums, x["i"]) + F.length(gap)
        before = F.right(gap, F.lit(SEEN))
        behind = F.left(F.get(gaps, x["i"] + 1), F.lit(SEEN))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(x["m"])).alias("end"),
            context_score(kind, before, behind).alias("score"),
        )

    each = F.transform(f"{kind.name}_m", lambda x, i: F.struct(x.alias("m"), i.alias("i")))
    return F.transform(F.filter(each, lambda x: confirmed(kind.name, x["m"])), span)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS
) -> DataFrame:
    """(doc_id, spans), one row per row of ``docs``.

    ``spans`` lists what was found by kind, in the order of ``kinds``, then by start, in code
    points with end exclusive. Matches that a checksum or a length refuses are dropped and not
    tried again at a later character. A null or empty text has no spans, an empty table no rows.
    Narrow: no shuffle, no Python; a text of any length is one row. Repeated rows give repeated results.
    Context is looked for up to the next span of the kind on each side.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    none = F.array().cast("array<string>")
    for kind in kinds:
        # Gaps and matches alternate: the start of match k is the size of gaps 0..k and matches before.
        has = F.col("text").rlike(kind.needs)
        rows = rows.withColumn(
            f"{kind.name}_m",
            F.when(has, F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))).otherwise(none),
        )
    for kind in kinds:
        found = F.size(f"{kind.name}_m") > 0
        rows = rows.withColumn(
            f"{kind.name}_g", F.when(found, F.split("text", kind.pattern, -1)).otherwise(none)
        )
    rows = rows.drop("text")
    for kind in kinds:
        rows = rows.withColumn(f"{kind.name}_s", sizes_of(kind.name))
    for kind in kinds:
        rows = rows.withColumn(f"{kind.name}_b", block_sums(F.col(f"{kind.name}_s")))
    every = [spans_of(kind) for kind in kinds]
    return rows.select("doc_id", F.concat(*every).cast(SPANS).alias("spans"))
