"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary classifier on character n-grams tells the
languages with a 1 from those with a 0; the language whose codeword loses least against all bits'
margins, each weighted by how well its classifier parts the languages, is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import struct_udf

UNKNOWN = "und"
SCHEMA = "lang_pred string, score double, second string, ambiguous boolean"


@dataclass(frozen=True)
class Settings:
    """``rows_per_language``: about how many labelled rows each classifier learns from, picked by
    a hash of the key from all of them; languages with fewer give all. ``max_languages``: so many
    labels are learned, those with the most rows (of equal ones the first by name); others are never
    predicted. ``bits``: log2 of the number of hashed n-grams. ``chunk``: characters held as arrays at a time. ``ambiguous_below``:
    scores under it are flagged."""

    rows_per_language: int = 4000
    max_languages: int = 1000
    bits: int = 14
    chunk: int = 1 << 18
    smooth: float = 0.5
    ambiguous_below: float = 0.6


def codewords(n: int):
    """``n`` codewords of +1 and -1, one per row; without bits where there is nothing to tell apart.

    Up to seven languages: every way to part them in two, once. More: rows of a Hadamard matrix
    without its constant column; any two differ in half of the bits.
    """
    import numpy as np

    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        splits = range(1, 2 ** (n - 1))
        return np.array(
            [[-1 if (s >> i) & 1 and i < n - 1 else 1 for s in splits] for i in range(n)], float
        ).reshape(n, len(splits))
    size = 1 << (n - 1).bit_length()
    return np.array(
        [[-1 if (i & j).bit_count() % 2 else 1 for j in range(1, size)] for i in range(n)], float
    )


def gram_counts(text: str, bits: int, chunk: int):
    """Counts of the hashed 1-, 2- and 3-grams of letters; every other ASCII character is a space."""
    import numpy as np

    fold = np.full(128, 32, np.uint64)
    for c in "abcdefghijklmnopqrstuvwxyz":
        fold[ord(c)] = ord(c)
    total = np.zeros(1 << bits, np.int64)
    lower = text.lower()
    for start in range(0, len(lower), chunk):
        part = lower[max(0, start - 2) : start + chunk]
        known = min(start, 2)  # these were counted with the chunk before
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        small = c < 128
        c[small] = fold[c[small]]
        grams = [(c + 1)[known:]]
        if len(c) > 1:
            pair = c[:-1] * np.uint64(0x10FFFF) + c[1:]
            grams.append((pair * np.uint64(3))[max(0, known - 1) :])
            if len(c) > 2:
                grams.append((pair[:-1] * np.uint64(0x10FFFF) + c[2:]) * np.uint64(5))
        h = np.concatenate(grams) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        total += np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return total


def sample_counts(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            sums: dict = {}
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                made = gram_counts(text.as_py(), settings.bits, settings.chunk)
                lang = lang.as_py()
                sums[lang] = sums[lang] + made if lang in sums else made
            for lang, counts in sums.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * len(at), "gram": at, "n": counts[at]},
                    schema=pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())]),
                )

    return run


@dataclass(frozen=True)
class Model:
    """Weights of each bit's classifier (n-gram by bit), how far its margins go for the languages,
    each bit's share of the loss, and the codewords."""

    languages: list
    code: object
    weights: object
    scale: object
    share: object


def fit(
    rows: DataFrame, key: Column, text_col: str, lang_col: str, settings: Settings = Settings()
) -> Model:
    """Learns from the labelled ``rows``; null texts, labels and keys are left out.

    The sample's n-grams are counted by Spark; the driver gets the sums alone, at most 2^bits
    numbers for each of at most ``max_languages`` labels. No labelled row: a model that says ``und``
    of everything; one label: a model that says nothing else of texts with a letter. Repeated rows count as
    often as they occur, empty texts have no n-grams. Rows with equal keys are picked together.
    """
    import numpy as np

    known = rows.select(
        key.cast("string").alias("key"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    ).filter("key is not null and text is not null and lang is not null")
    largest = known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang")
    sizes = {r["lang"]: r["count"] for r in largest.limit(settings.max_languages).collect()}
    languages = sorted(sizes)
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, None, None, None)
    fine = 1_000_000
    parts = {x: -(-settings.rows_per_language * fine // n) for x, n in sizes.items()}
    # One flat expression: a nested one would be as deep as there are languages. Of labels that are
    # not learned no row is picked.
    at = F.when(F.lit(False), F.lit(0))
    for x in languages:
        at = at.when(F.col("lang") == x, F.lit(min(fine, parts[x])))
    sample = known.filter(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(fine)) < at)
    sums = (
        sample.mapInArrow(sample_counts(settings), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.full((len(languages), 1 << settings.bits), settings.smooth)
    row_of = {x: i for i, x in enumerate(languages)}
    rows_at = np.array([row_of[x] for x in sums["lang"].to_pylist()], int)
    np.add.at(counts, (rows_at, sums["gram"].to_numpy()), sums["n"].to_numpy())
    p = counts / counts.sum(1, keepdims=True)  # every language weighs the same
    weights = np.stack(
        [
            np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0))
            for b in range(code.shape[1])
        ],
        1,
    )
    margins = p @ weights * code  # of each language's own n-grams, positive where right
    scale = np.maximum(np.abs(margins).mean(0), 1e-9)
    share = np.maximum(margins.min(0) / scale, 0.05)
    return Model(languages, code, weights, scale, share / share.sum())


def predictor(model: Model, settings: Settings):
    import numpy as np
    import regex

    letter = regex.compile(r"\p{L}")
    languages, code = model.languages, model.code

    def one(text: str | None) -> tuple:
        if not text or not languages or not letter.search(text):
            return UNKNOWN, 0.0, None, True
        if len(languages) == 1:
            return languages[0], 1.0, None, False
        counts = gram_counts(text, settings.bits, settings.chunk)
        margins = counts @ model.weights / counts.sum() / model.scale
        loss = (np.logaddexp(0, -2 * code * margins) * model.share).sum(1)
        order = np.argsort(loss, kind="stable")
        chance = np.exp(4 * (loss[order[0]] - loss))
        score = float(1 / chance.sum())
        return (
            languages[order[0]],
            score,
            languages[order[1]],
            score < settings.ambiguous_below,
        )

    return one


def identify_language(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    into: str = "language",
    settings: Settings = Settings(),
) -> DataFrame:
    """``docs`` with a struct column ``into``: language, score between 0 and 1, the runner-up, and
    whether the two are hard to tell apart, for each row.

    Reads nothing but the text, all of it; arrays hold ``chunk`` characters of it at a time, so a text of
    any length takes bounded memory besides its own. Null texts and such without a letter are ``und`` with
    score 0, as is everything where no language was learned. Of languages with equal losses the first by name
    is chosen, and repeated rows get equal results. A table that has a column named as ``into`` is refused. An
    empty table gives no rows. Narrow: no shuffle.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {into!r} already")
    return docs.withColumn(
        into, struct_udf(lambda: predictor(model, settings), SCHEMA)(F.col(text_col))
    )
