"""Quality rules: Jensen-Shannon distance of a document to the reference of its language.

Two histograms describe a text: its characters by class, and its words over the language's common
words and "any other". A language's reference is the sum over all its documents that pass the base
rules. A document far from its language's reference is rejected, where it is long enough to tell.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import struct_udf
from foliospark.session import shared_path

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
EDGES = b".,;:!?\"'()[]{}#*$%&|<>-_=/\\"

SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, class_distance double, word_distance double,"
    " kept boolean"
)


@dataclass(frozen=True)
class Rules:
    """``common_share``: words that make up at least this share of a language's words are its
    common words (so it has at most 1 / common_share of them). ``language_share``: labels with less
    than this share of all words are counted together; no text is judged by them, by null labels or
    by labels with fewer than ``min_documents`` documents. Distances lie between 0 and 1; beyond the
    limits a text of at least the given size is rejected. ``word_limit`` is a fraction of the
    distance that a text without any common word has to the reference; a text of which less than
    ``word_min_common`` common words are expected is too short to tell."""

    common_share: float = 0.002
    language_share: float = 0.00001
    min_documents: int = 10
    class_limit: float = 0.33
    class_min_chars: int = 200
    word_limit: float = 0.95
    word_min_words: int = 100
    word_min_common: float = 20


def class_table():
    """Class of each byte: lower and upper case, digit, space, symbol, other punctuation, first
    byte of a character beyond ASCII; 7 for bytes that are not counted."""
    import numpy as np

    table = np.full(256, 5, np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[ord(c) for c in SPACE]] = 3
    table[[ord(c) for c in SYMBOLS]] = 4
    table[0xC0:] = 6
    table[0x80:0xC0] = 7
    return table


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that stand in the text twice or more."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    pairs = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    _, at, times = np.unique(
        pairs[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True
    )
    again = times[at] > 1
    hit = np.zeros(n, bool)
    for i in range(3):
        hit[i : n - 2 + i] |= again
    return int(hit.sum())


def base_counts(text: str) -> tuple[list[bytes], tuple[int, int, int, int, int], bool]:
    """The words, their counts and whether the base rules fail."""
    words = text.encode("utf-8", "surrogatepass").split()  # exactly at the six ASCII spaces
    chars = len(text) - sum(text.count(c) for c in SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated = repeated_words(words)
    counts = (len(words), chars, symbols, len(lines) - len(set(lines)), repeated)
    return words, counts, len(words) < 50 or 100 * repeated > 50 * len(words)


def plain(word: bytes) -> bytes:
    return word.lower().strip(EDGES)


def class_counts(text: str, table) -> list[int]:
    import numpy as np

    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return np.bincount(table[raw], minlength=8)[:7].tolist()


def distance(p: list[float], q: list[float]) -> float:
    """Jensen-Shannon distance, base 2, of two histograms; 1 if one of them is empty."""
    a, b = sum(p), sum(q)
    if not a or not b:
        return 1.0
    total = 0.0
    for x, y in zip(p, q, strict=True):
        x, y = x / a, y / b
        m = (x + y) / 2
        if x:
            total += x * math.log2(x / m) / 2
        if y:
            total += y * math.log2(y / m) / 2
    return math.sqrt(min(1.0, max(0.0, total)))


def counted(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang")
    ).filter(F.col("text").isNotNull())


COUNTS = "lang string, kind string, key binary, n bigint"


def summary(counts: dict[bytes, int], size: int) -> dict[bytes, int]:
    """At most ``size`` of the counts, each lowered by the next smaller one.

    A count is lowered by no more than the sum of all, divided by ``size`` + 1, and the same holds
    for sums of such summaries (Misra and Gries; Agarwal and others, Mergeable summaries).
    """
    if len(counts) <= size:
        return counts
    cut = heapq.nlargest(size + 1, counts.values())[-1]
    return {w: n - cut for w, n in counts.items() if n > cut}


def counter(common: dict[str, set[bytes]] | None, size: int, pooled: set[str] | None = None):
    """Sums by language over one batch of texts that pass the base rules.

    Without ``common``: a summary of the words and the number of all words ("words"). With
    ``common``: the counts of those words, of all words, of the texts ("texts") and of the character
    classes ("class"); languages outside ``pooled`` count as the empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        table = class_table()
        for batch in batches:
            words: dict[str, Counter] = {}
            classes: dict[str, list[int]] = {}
            totals: Counter = Counter()
            texts: Counter = Counter()
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                text, lang = text.as_py(), lang.as_py()
                if pooled is not None and lang not in pooled:
                    lang = ""
                found, counts, failed = base_counts(text)
                if failed:
                    continue
                known = words.setdefault(lang, Counter())
                totals[lang] += counts[0]
                texts[lang] += 1
                if common is None:
                    known.update(map(plain, found))
                else:
                    held = common.get(lang, ())
                    known.update(w for w in map(plain, found) if w in held)
                    made = class_counts(text, table)
                    classes[lang] = [
                        a + b for a, b in zip(classes.get(lang, [0] * 7), made, strict=True)
                    ]
            rows = []
            for lang, known in words.items():
                if common is None:
                    known.pop(b"", None)
                    known = summary(known, size)
                rows += [(lang, "word", w, n) for w, n in known.items() if w]
                rows.append((lang, "words", b"", totals[lang]))
                if common is not None:
                    rows.append((lang, "texts", b"", texts[lang]))
                rows += [(lang, "class", b"%d" % i, n) for i, n in enumerate(classes.get(lang, []))]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("lang", "kind", "key", "n"), r, strict=True)) for r in rows],
                schema=pa.schema(
                    [("lang", pa.string()), ("kind", pa.string()), ("key", pa.binary()), ("n", pa.int64())]
                ),
            )

    return run


def common_candidates(rows: DataFrame, rules: Rules) -> dict[str, set[bytes]]:
    """Per language a superset of its common words, at most 2 / common_share of them.

    Languages with less than ``language_share`` of all words are the empty one together, so there
    are at most 1 / language_share others. Summaries of batches are added up by Spark; a common
    word keeps at least half of ``common_share`` in the sum.
    """
    spark = rows.sparkSession
    work = shared_path(spark, "quality-rules")
    size = math.ceil(2 / rules.common_share)
    sums = rows.mapInArrow(counter(None, size), COUNTS).groupBy("lang", "kind", "key")
    sums.agg(F.sum("n").alias("n")).write.parquet(f"{work}/summaries")
    sums = spark.read.parquet(f"{work}/summaries")
    totals = sums.filter("kind = 'words'")
    every = totals.agg(F.sum("n")).first()[0] or 0
    large = totals.filter(F.col("n") >= rules.language_share * every).select("lang", F.lit(True).alias("large"))
    lang = F.when(F.col("large"), F.col("lang")).otherwise("").alias("lang")
    named = sums.join(F.broadcast(large), "lang", "left").select(lang, "kind", "key", "n")
    pooled = named.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    sizes = pooled.filter("kind = 'words'").select("lang", F.col("n").alias("total"))
    out: dict[str, set[bytes]] = {r["lang"]: set() for r in sizes.collect()}
    # A row for each of at most 1 / language_share + 1 languages.
    found = pooled.filter("kind = 'word'").join(F.broadcast(sizes), "lang")
    for r in found.filter(F.col("n") >= rules.common_share / 2 * F.col("total")).collect():
        out[r["lang"]].add(bytes(r["key"]))
    return out


def language_references(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()
) -> dict[str, tuple[list[int], dict[bytes, int], int]]:
    """Per language: character classes, common words with their counts, number of words.

    Two passes over all documents: candidates for common words from summaries, then exact counts of
    those candidates. What the driver gets is bounded by ``rules`` alone: 1 / language_share
    languages with 2 / common_share words each. A null language is the empty one; null texts and
    such that fail the base rules count nowhere.
    """
    return _references(docs, text_col, lang_col, rules)[0]


def _references(docs: DataFrame, text_col: str, lang_col: str, rules: Rules) -> tuple[dict, dict[str, int]]:
    """The references, and the number of texts behind each."""
    rows = counted(docs, text_col, lang_col)
    candidates = common_candidates(rows, rules)
    second = rows.mapInArrow(counter(candidates, 0, set(candidates)), COUNTS)
    out: dict[str, tuple[list[int], dict[bytes, int], int]] = {}
    words: dict[str, dict[bytes, int]] = {}
    texts: dict[str, int] = {}
    for r in second.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")).collect():
        classes, _, total = out.get(r["lang"], ([0] * 7, {}, 0))
        if r["kind"] == "class":
            classes[int(r["key"])] = r["n"]
        elif r["kind"] == "words":
            total = r["n"]
        elif r["kind"] == "texts":
            texts[r["lang"]] = r["n"]
        else:
            words.setdefault(r["lang"], {})[bytes(r["key"])] = r["n"]
        out[r["lang"]] = (classes, {}, total)
    references = {
        lang: (
            classes,
            {
                w: n
                for w, n in sorted(words.get(lang, {}).items())
                if n >= rules.common_share * total
            },
            total,
        )
        for lang, (classes, _, total) in sorted(out.items())
    }
    return references, texts


def judge(references: dict, rules: Rules):
    """The function of one text and its label."""
    table = class_table()
    refs = {}
    for lang, (classes, words, total) in references.items():
        expected = [*words.values(), total - sum(words.values())]
        # Nothing is told by a language without common words: a text without any is like the rest.
        nothing = distance([0] * len(words) + [1], expected) if words else 0.0
        share = sum(words.values()) / total if total else 0.0
        refs[lang] = (classes, list(words), expected, nothing, share)

    def one(text: str | None, lang: str | None) -> tuple:
        words, counts, failed = base_counts(text or "")
        n_words, chars = counts[0], counts[1]
        by_class = by_word = None
        far = False
        asked = [refs[lang]] if lang in refs else list(refs.values())
        if asked and chars >= rules.class_min_chars:
            own = class_counts(text, table)
            by_class = min(distance(own, classes) for classes, *_ in asked)
            far = by_class > rules.class_limit
        if n_words >= rules.word_min_words:
            own = {}
            for w in map(plain, words):
                own[w] = own.get(w, 0) + 1
            found = []
            for _, common, expected, nothing, share in asked:
                if nothing:
                    n = [own.get(w, 0) for w in common]
                    d = distance([*n, n_words - sum(n)], expected)
                    found.append((d / nothing, -share, d))
            # Of languages equally near, that with the most common words can tell best.
            part, share, d = min(found, default=(0.0, 0.0, 0.0))
            if -share * n_words >= rules.word_min_common:
                by_word = d
                far = far or part > rules.word_limit
        return *counts, failed, by_class, by_word, not failed and not far

    return one


def rate_quality(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    into: str = "quality",
    rules: Rules = Rules(),
) -> DataFrame:
    """``docs`` with a struct column ``into``: what ``SCHEMA`` lists, for each row.

    A null or empty text has no words and fails the base rules. Distances are to the reference of
    the text's own label. Where the label is null or empty, or has no reference because fewer than
    ``min_documents`` of its documents pass the base rules, they are to the nearest language; no
    reference is made of such labels. Distances are null for texts below the length guards, where
    no language has a reference, and by words where too few common words are expected to tell.
    Repeated rows count as often as they stand there. Scoring is narrow; only sums by language and
    word are shuffled.
    """
    references, texts = _references(docs, text_col, lang_col, rules)
    real = {
        lang: r for lang, r in references.items() if lang and texts.get(lang, 0) >= rules.min_documents
    }
    score = struct_udf(lambda: judge(real, rules), SCHEMA)
    return docs.withColumn(into, score(F.col(text_col), F.col(lang_col)))
