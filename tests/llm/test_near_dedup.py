"""Near-duplicates against brute force: exact similarity of all pairs of a small table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliospark.llm import near_dedup as N
from foliospark.llm import queries as Q
from tests.llm import brute


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def similar(a, b):
    if not a or not b or min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
        return False
    common = len(set(a) & set(b))
    if common < 0.4 * len(set(a) | set(b)):
        return False
    n = lcs(a, b)
    return n / (len(a) + len(b) - n) >= 0.8


def classes(rows):
    """The smallest id of each document's class, by comparing all pairs of texts."""
    first = {}
    for i, t in rows:
        if t is not None:
            first[t] = min(i, first.get(t, i))
    texts = [(t, brute.words(t)) for t in first]
    parent = {t: t for t in first}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for k, (t, a) in enumerate(texts):
        for u, b in texts[:k]:
            if root(t) != root(u) and similar(a, b):
                parent[root(t)] = root(u)
    low = {}
    for t in first:
        low[root(t)] = min(first[t], low.get(root(t), first[t]))
    return {i: i if t is None else low[root(t)] for i, t in rows}


def found(df, **options):
    rows = N.near_groups(df, settings=N.Settings(**options)).collect()
    return {r.doc_id: r.class_id for r in rows}


def test_table(spark):
    docs = Q.read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: r.class_id for r in Q.op4_near_dedup(spark, "/root/testdata/sf0.001").collect()} == classes(rows)


@pytest.fixture(scope="module")
def crowd():
    """Copies of a text with edits, a chain, and documents around a passage that all share."""
    rng = random.Random(5)

    def prose(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    texts = []
    base = prose(150)
    for k in range(60):
        w = list(base)
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = "edit"
        texts.append(" ".join(w))
    chain = prose(120)
    for _ in range(12):
        chain = [*chain[4:], *prose(4)]
        texts.append(" ".join(chain))
    passage = prose(60)
    for k in range(150):
        texts.append(" ".join([*passage, *prose(4 + k % 40)]))
    texts += [" ".join(prose(200)) for _ in range(20)]
    twin = [*passage, *prose(30)]
    texts += [" ".join(twin), " ".join([*twin[:-1], "other"])]
    return list(enumerate(texts))


@pytest.mark.parametrize("joined", [0, 1, 16, 10_000])
def test_crowd(spark, crowd, joined):
    df = spark.createDataFrame(crowd, "doc_id long, text string")
    want = classes(crowd)
    assert len(set(want.values())) > 50
    assert found(df, joined_pairs=joined, block=20) == want
    if joined == 0:
        assert found(df, joined_pairs=joined, block_words=3_000) == want


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i // 3}" for i in range(60_000))
    rows = [
        (5, None), (4, None), (1, ""), (0, ""), (2, " "), (3, "#"), (8, "#"), (9, "one two"), (7, "One, two!"),
        (None, "one two"), (None, None), (6, "alone"), (6, "alone"), (6, "other text of the same id"),
        (20, long), (21, long.replace("w5x", "v5x")), (22, "a " * 5000), (23, "a " * 5200),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("node", F.lit(2))
    got = sorted(
        ((r.doc_id, r.class_id, r.copy_of) for r in N.near_groups(df).collect()),
        key=lambda r: tuple((x is not None, x) for x in r),
    )
    assert got == [
        (None, None, None), (None, 7, 9), (0, 0, 0), (1, 0, 0), (2, 2, 2), (3, 3, 3), (4, 4, 4), (5, 5, 5),
        (6, 6, 6), (6, 6, 6), (6, 6, 6), (7, 7, 7), (8, 3, 3), (9, 7, 9), (20, 20, 20), (21, 20, 21),
        (22, 22, 22), (23, 22, 23),
    ]
    kept = N.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.select("doc_id", F.substring("text", 1, 9).alias("text")).collect()), key=str) == sorted(
        [(None, "one two"), (None, None), (0, ""), (2, " "), (3, "#"), (4, None), (5, None), (6, "alone"),
         (6, "other tex"), (7, "One, two!"), (20, long[:9]), (22, "a a a a a")], key=str
    )
    assert N.near_groups(df.limit(0)).count() == 0 and N.one_of_each(df.limit(0)).count() == 0


def test_pairs_that_share_one_crowded_sketch(spark):
    """Two similar texts and a third, unlike both, meet in one sketch; the third may be its centre."""
    rng = random.Random(8)

    def prose(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    options = {"sketches": 1, "picks": 1}
    one, texts = N.sketcher(N.Settings(**options)), []
    while len(texts) < 90:
        passage = prose(60)
        three = [" ".join([*passage, *prose(n)]) for n in (5, 5, 17)]
        if len({one(t)[1][0] for t in three}) == 1:
            texts += three
    rows = list(enumerate(texts))
    want = classes(rows)
    assert all(want[i] == i - i % 3 for i in want if i % 3 < 2) and all(want[i] == i for i in want if i % 3 == 2)
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), **options) == want


def edited(rng, words, share):
    """``words`` with a share of them replaced, deleted or with another word in front."""
    out = []
    for w in words:
        if rng.random() >= share:
            out.append(w)
            continue
        out += rng.choice([["new"], [], ["more", w]])
    return out


@pytest.mark.parametrize("length, least", [(30, 0.8), (100, 0.93), (400, 0.97), (1500, 0.98)])
def test_edited_texts_are_candidates(length, least):
    """Of texts of which 1 to 8 in a hundred words were edited, those that are similar share a sketch."""
    rng = random.Random(length)
    one = N.sketcher(N.Settings())
    both = similar_ones = 0
    for k in range(400):
        a = [f"w{rng.randrange(10**9)}" for _ in range(length)]
        b = edited(rng, a, (1 + k % 8) / 100)
        gaps = len(a) + len(b) - 2 * N.common_in_order(a, b, length)
        if (len(a) + len(b) - gaps) / (len(a) + len(b) + gaps) >= 0.8:
            similar_ones += 1
            both += bool(set(one(" ".join(a))[1]) & set(one(" ".join(b))[1]))
    assert similar_ones > 300 and both >= least * similar_ones


@pytest.mark.parametrize("percent", [1, 2, 4, 6, 8])
def test_edited_copies_are_linked(spark, percent):
    rng = random.Random(percent)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(edited(rng, words, percent / 100)))]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    linked = sum(got[2 * k] == got[2 * k + 1] for k in range(60))
    assert linked >= (60 if percent <= 4 else 57)
    assert len(set(got.values())) == 120 - linked


def test_banded_alignment_is_the_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        n, kinds = rng.randrange(1, 700), rng.choice([2, 9, 10**6])
        a = [rng.randrange(kinds) for _ in range(n)]
        b = [x for x in a if rng.random() > 0.05]
        for _ in range(rng.randrange(8)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(kinds))
        true = lcs(a, b)
        gaps = len(a) + len(b) - 2 * true
        assert N.common_in_order(a, b, gaps) == true
        assert N.common_in_order(a, b, 3) <= true
        want = true / (len(a) + len(b) - true) if b else 0
        if want >= 0.8:
            assert N.similarity(a, b, 0.8) == pytest.approx(want)
        else:
            assert N.similarity(a, b, 0.8) <= want


def test_pipeline_stages_on_odd_documents(spark):
    prose = " ".join(f"the word{i} of and to in" for i in range(60))
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (1, prose, "en", "s", len(prose)), (2, prose, "en", "s", len(prose)), (3, None, None, None, None),
        (4, "", "en", "s", 0), (5, f"{prose} token = abcdefghijklmnop", "en", "s", 1),
        (6, f"{item} {' '.join(f'unlike{i} the of and' for i in range(60))}", "en", "s", 1), (None, prose + " x", None, "s", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumn("quality", F.lit(1)).withColumn("redacted", F.lit(2)).withColumn("contamination", F.lit(3))
    stages = dict(corpus_pipeline.STAGES)
    folder = spark.conf.get("spark.checkpoint.dir") + "/bench-of-test"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    for name in ("quality", "near_duplicates", "decontamination", "secrets"):
        for docs in (df, df.limit(0)):
            made = stages[name](spark, docs, folder)
            assert made.columns == df.columns and made.schema.simpleString() == df.schema.simpleString()
    ids = lambda made: sorted((r.doc_id for r in made.select("doc_id").collect()), key=str)
    assert 3 not in ids(stages["quality"](spark, df, folder)) and 4 not in ids(stages["quality"](spark, df, folder))
    assert ids(stages["near_duplicates"](spark, df, folder)) == [1, 3, 4, 6, None]
    assert ids(stages["decontamination"](spark, df, folder)) == [1, 2, 3, 4, 5, None]
    clean = {r.doc_id: r for r in stages["secrets"](spark, df, folder).collect()}
    assert clean[5].text.endswith(" <SECRET>") and clean[5].n_chars == len(clean[5].text)
    assert clean[3].text is None and clean[1].text == prose and len(clean) == 7
    assert stages["tokens"](spark, df, folder).count() == 7


def test_pipeline_against_plain_stages(spark):
    """run() over the small table against the stages' own contracts, one after the other."""
    from tokenizers import Tokenizer

    small = "/root/testdata/sf0.001"
    docs = Q.read(spark, small, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    good = {r.doc_id for r in Q.op9_quality_rules(spark, small).filter("kept").collect()}
    group = classes([(i, texts[i]) for i in sorted(good)])
    bench = [(r.item_id, r.text) for r in Q.read(spark, small, "benchmark").collect()]
    kept = [i for i in sorted(good) if group[i] == i and not brute.op3(texts[i], bench)["contaminated"]]
    redact = corpus_pipeline.secret_scan.redactor("<SECRET>")
    tokenizer = Tokenizer.from_file(Q.vocabulary_path())
    want = {i: brute.op7(redact(texts[i])[0], tokenizer) for i in kept}
    got = {r.doc_id: r.asDict() for r in corpus_pipeline.run(spark, small).collect()}
    assert {i: {k: r[k] for k in ("n_tokens", "ids_sha256", "decoded_sha256")} for i, r in got.items()} == want
