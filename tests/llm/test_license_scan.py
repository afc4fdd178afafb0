"""License labels against a plain search: every stretch of words by its edit distance."""

import random

import pytest
from pyspark.sql import functions as F

from foliospark.llm import license_scan as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(text):
    """(label, edits, characters) of every stretch of words that is close to a notice."""
    words, found = text.split(" "), []
    for x in (*L.BASE, *L.NOTICES):
        short = [w for w in x.words.split(" ") if len(w) <= 4]
        n = len(x.words.split(" "))
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + n + 3) + 1):
                stretch = " ".join(words[i:j])
                if abs(len(stretch) - len(x.words)) > x.edits:
                    continue
                rest = iter(words[i:j])
                if all(any(w == y for y in rest) for w in short):
                    edits = distance(stretch, x.words)
                    if edits <= x.edits:
                        found.append((x.label, edits, len(x.words)))
    return found


def test_labels_of_edited_notices():
    r = random.Random(11)
    one = L.scanner(L.NOTICES, L.BASE)
    labelled = 0
    for k in range(260):
        x = r.choice((*L.BASE, *L.NOTICES))
        letters = list(x.words)
        for _ in range(r.randrange(x.edits + 2)):
            at = r.randrange(len(letters))
            change = r.choice("rid")
            if change == "d":
                del letters[at]
            else:
                letters[at : at + (change == "r")] = r.choice("abcdefxyz")
        words = [r.choice(["the", "omit", "gnu", "license", "public", "code"]) for _ in range(6)]
        text = " ".join([*words[:3], *"".join(letters).split(), *words[3:]])
        want, made = plain(text), one(text)
        labels, score, spans = made[5], made[6], made[7]
        assert set(filter(None, labels.split(","))) == {label for label, _, _ in want}, text
        assert score <= max((1 - e / n for _, e, n in want), default=0.0) + 1e-9
        for s in spans:
            assert any(label == s["label"] and e <= s["edits"] for label, e, _ in want)
            assert text[s["start"] - 1] == " " and (s["end"] == len(text) or text[s["end"]] == " ")
        labelled += bool(want)
    assert labelled > 150


@pytest.mark.parametrize(
    "text, labels",
    [
        ("omit license", ""), ("emit license", ""), ("bit license", ""), ("mit licence", "mit"), ("mit licenses", "mit"),
        ("released under the bit license", ""), ("gnu lesser general public licence", "gpl,lgpl"), ("apach license", "apache"),
    ],
)
def test_short_words_stand_as_they_are(text, labels):
    assert L.scanner(L.NOTICES, L.BASE)(f"code {text} code")[5] == labels


def test_clashing_column_and_empty_table(spark):
    docs = spark.createDataFrame([("MIT License", 1)], "text string, licenses int")
    with pytest.raises(ValueError):
        L.scan_licenses(docs)
    made = L.scan_licenses(docs, into="found")
    assert made.columns == ["text", "licenses", "found"] and made.first().found.base_labels == "mit"
    assert L.scan_licenses(docs.limit(0), into="found").select(F.col("found.labels")).collect() == []
