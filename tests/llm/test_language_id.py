"""Language identification against a plain version of the method, on odd and degenerate tables."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliospark.llm import language_id as L
from foliospark.llm import queries as Q
from tests.llm.test_contracts import LONG, ODD, SMALL

M64 = (1 << 64) - 1


def plain_grams(text, bits=14):
    c = [ord(x) for x in text.lower()]
    c = [x if x >= 128 or 97 <= x <= 122 else 32 for x in c]
    keys = [x + 1 for x in c]
    pairs = [a * 0x10FFFF + b for a, b in zip(c, c[1:])]
    keys += [p * 3 for p in pairs]
    keys += [(p * 0x10FFFF + x) * 5 for p, x in zip(pairs, c[2:])]
    out = Counter()
    for k in keys:
        h = (k & M64) * 0x9E3779B97F4A7C15 & M64
        h ^= h >> 29
        out[(h * 0xBF58476D1CE4E5B9 & M64) >> (64 - bits)] += 1
    return out


def plain_codes(n):
    """Up to seven: all ways to part the languages in two; else the rows of a Hadamard matrix."""
    if n <= 7:
        ways = range(1, 2 ** (n - 1))
        return [[-1 if i < n - 1 and way >> i & 1 else 1 for way in ways] for i in range(n)]
    size = 1 << (n - 1).bit_length()
    return [[(-1) ** bin(i & j).count("1") for j in range(1, size)] for i in range(n)]


def plain_predictions(labelled, texts, bits=14):
    langs = sorted({x for _, x in labelled if x is not None})
    letters = lambda t: any(ch.isalpha() for ch in t or "")
    if not langs:
        return [("und", 0.0) for _ in texts]
    size = 1 << bits
    code = plain_codes(len(langs))
    share = []
    for x in langs:
        sums = Counter()
        for text, lang in labelled:
            if lang == x and text is not None:
                sums.update(plain_grams(text, bits))
        total = sum(sums.values()) + size / 2
        share.append([(sums[g] + 0.5) / total for g in range(size)])
    bit_weights, scales, shares = [], [], []
    for b in range(len(code[0])):
        plus = [i for i in range(len(langs)) if code[i][b] > 0]
        minus = [i for i in range(len(langs)) if code[i][b] < 0]
        w = [
            math.log(sum(share[i][g] for i in plus) / len(plus)) - math.log(sum(share[i][g] for i in minus) / len(minus))
            for g in range(size)
        ]
        margins = [code[i][b] * sum(p * x for p, x in zip(share[i], w)) for i in range(len(langs))]
        scale = max(sum(map(abs, margins)) / len(margins), 1e-9)
        bit_weights.append(w)
        scales.append(scale)
        shares.append(max(min(margins) / scale, 0.05))
    out = []
    for text in texts:
        if not letters(text):
            out.append(("und", 0.0))
            continue
        if len(langs) == 1:
            out.append((langs[0], 1.0))
            continue
        grams = plain_grams(text, bits)
        n = sum(grams.values())
        losses = [0.0] * len(langs)
        for b, w in enumerate(bit_weights):
            margin = sum(k * w[g] for g, k in grams.items()) / n / scales[b]
            for i in range(len(langs)):
                losses[i] += math.log1p(math.exp(-2 * code[i][b] * margin)) * shares[b] / sum(shares)
        best = min(range(len(langs)), key=lambda i: losses[i])
        out.append((langs[best], 1 / sum(math.exp(4 * (losses[best] - x)) for x in losses)))
    return out


def fitted(spark, labelled, **options):
    rows = [(str(i), t, x) for i, (t, x) in enumerate(labelled)]
    frame = spark.createDataFrame(rows, "key string, text string, lang string")
    settings = L.Settings(**options)
    return L.fit(frame, F.col("key"), "text", "lang", settings), settings


def predicted(spark, model, texts, settings):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    rows = L.identify_language(docs, model, settings=settings).select("doc_id", "language.*").collect()
    return {r.doc_id: r for r in rows}


def compare(spark, labelled, texts, bits=10):
    model, settings = fitted(spark, labelled, bits=bits)
    got = predicted(spark, model, texts, settings)
    for i, (lang, score) in enumerate(plain_predictions(labelled, texts, bits)):
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, rel=1e-6), (i, texts[i])
        assert got[i].ambiguous == (got[i].score < 0.6)


def table_rows(spark):
    docs = Q.read(spark, SMALL, "documents").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    return [(d.text, d.lang) for d in docs]


def test_table_against_the_plain_method(spark):
    rows = table_rows(spark)
    compare(spark, rows[:80], [t[:400] for t, _ in rows[80:130]] + ["e", "é", "ß"])


def test_nine_languages(spark):
    rows = [(f"{chr(97 + i)}{chr(98 + i)} " * 20 + "common words", f"l{i}") for i in range(9)]
    compare(spark, [*rows, (None, "l0"), ("text without label", None)], [t[:30] for t, _ in rows])


@pytest.mark.parametrize(
    "labelled", [[], [("some text", None)], [(None, "en")], [("some text", "en")], [("", "en"), ("", "fr")], [("1 2", "en"), ("x", "fr")]]
)
def test_tables_with_little_to_learn(spark, labelled):
    texts = ["some text", "", None, "123 .", "été"]
    model, settings = fitted(spark, labelled)
    got = predicted(spark, model, texts, settings)
    learned = {x for t, x in labelled if x and t is not None}
    for i, text in enumerate(texts):
        if learned and text and any(c.isalpha() for c in text):
            assert got[i].lang_pred in learned and 0 < got[i].score <= 1
        else:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)


def test_odd_rows_and_clashing_columns(spark):
    rows = table_rows(spark)[:60]
    model, settings = fitted(spark, rows)
    texts = [*ODD, *LONG, "the of and", "the of and"]
    got = predicted(spark, model, texts, settings)
    assert len(got) == len(texts) and got[len(texts) - 1][1:] == got[len(texts) - 2][1:]
    docs = spark.createDataFrame([("x", 1, 2)], "text string, language int, score int")
    with pytest.raises(ValueError):
        L.identify_language(docs, model)
    made = L.identify_language(docs, model, into="found")
    assert made.columns == ["text", "language", "score", "found"] and made.count() == 1
    assert L.identify_language(docs.limit(0), model, into="found").count() == 0


def test_more_labels_than_are_learned(spark):
    rows = [(f"word{i}", f"l{i:02}") for i in range(40)] + [("bonjour le monde", "fr")] * 3 + [("hello the world", "en")] * 2
    model, settings = fitted(spark, rows, max_languages=2)
    assert model.languages == ["en", "fr"]
    got = predicted(spark, model, ["le monde", "the world"], settings)
    assert [got[i].lang_pred for i in range(2)] == ["fr", "en"]


@pytest.mark.parametrize("change", ["empty", "unlabelled", "one"])
def test_query_on_degenerate_tables(spark, tmp_path, change):
    docs = Q.read(spark, SMALL, "documents")
    docs = {
        "empty": docs.limit(0),
        "unlabelled": docs.withColumn("lang", F.lit(None).cast("string")),
        "one": docs.withColumn("lang", F.lit("xx")),
    }[change]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = Q.op2_language_id(spark, str(tmp_path))
    want = {"empty": set(), "unlabelled": {"und"}, "one": {"xx"}}[change]
    assert {r.lang_pred for r in found.collect()} - {"und"} == want - {"und"} and found.count() == docs.count()
