"""Scores of personal data against a plain reading of the words around."""

import random
import re

import pytest

from foliospark.llm import pii

SAMPLES = {
    "email": "someone@example.org", "ip": "10.20.30.40", "card": "4111 1111 1111 1111", "phone": "+49 89 1234567",
    "iban": "GB82WEST12345698765432",
}


def plain_score(kind, before, behind):
    """From the words of the text: how far the nearest one of each list is."""

    def weight(words):
        best = None
        for m in re.finditer("[A-Za-z]+[0-9]*", before):
            if m.group().lower() in words or re.sub("[0-9]+$", "", m.group()).lower() in words:
                gap = len(before) - m.end() if m.group().lower() in words else len(before) - m.start() - len(re.sub("[0-9]+$", "", m.group()))
                best = min(gap, 10**9 if best is None else best)
        for m in re.finditer("[A-Za-z]+[0-9]*", behind):
            if m.group().lower() in words or re.sub("[0-9]+$", "", m.group()).lower() in words:
                best = min(m.start(), 10**9 if best is None else best)
        return 0.0 if best is None or best > 40 else 1.0 if best <= 15 else 0.5

    return min(1.0, max(0.0, kind.score + kind.lift * (weight(kind.context) - weight(kind.against))))


def test_scores_against_the_plain_reading(spark):
    r = random.Random(4)
    filler = ["ship", "hotel", "the", "of", "discard", "postcard", "versions", "x", "-", "recall", "a", "(", "ghost"]
    rows = []
    for i in range(400):
        kind = r.choice(pii.KINDS)
        words = filler + [w.upper() if r.random() < 0.3 else w for w in (*kind.context, *kind.against)]
        sides = [" ".join(r.choices(words, [3] * len(filler) + [1] * (len(words) - len(filler)), k=r.randrange(9))) for _ in (0, 1)]
        rows.append((i, kind, f"{sides[0]} ", f" {sides[1]}"))
    texts = [(i, f"{a}{SAMPLES[k.name]}{b}") for i, k, a, b in rows]
    found = pii.find_pii(spark.createDataFrame(texts, "doc_id int, text string")).collect()
    spans = {x.doc_id: x.spans for x in found}
    for i, kind, before, behind in rows:
        mine = [s for s in spans[i] if s.kind == kind.name and s.start == len(before)]
        assert len(mine) == 1 and mine[0].score == pytest.approx(plain_score(kind, before, behind)), texts[i]


@pytest.mark.parametrize(
    "text, score",
    [
        ("the ship 1.2.3.4", 0.6), ("ip 1.2.3.4", 0.9), ("1.2.3.4 is my server address", 0.9), ("version 1.2.3.4", 0.3),
        ("hotel +49 89 1234567", 0.5), ("tel. +49 89 1234567", 0.8), ("ip address of version 1.2.3.4", 0.6),
        ("server " + "x" * 20 + " 1.2.3.4", 0.75), ("server " + "x" * 50 + " 1.2.3.4", 0.6), ("a@b.org is my email", 1.0),
    ],
)
def test_examples(spark, text, score):
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [s.score for s in row.spans] == pytest.approx([score])


def test_no_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "ip 1.2.3.4", "x")], "doc_id int, text string, ip_m string")
    assert pii.find_pii(docs).first().spans[0].score == 0.9
    assert pii.find_pii(docs.limit(0)).collect() == []
