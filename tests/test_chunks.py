import random

from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions import text as T
from foliospark.operators import chunks as C


def greedy(paragraphs, limit):
    """Brute-force packing for comparison."""
    done, current = [], []
    for p in paragraphs:
        if current and sum(map(len, current)) + len(p) > limit:
            done.append(current)
            current = []
        current.append(p)
    return ["\n\n".join(c) for c in [*done, current]]


def packed(spark, texts, limit):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string")
    rows = C.chunk_rows(docs, ["doc_id"], max_chars=limit).orderBy("doc_id", "chunk_idx").collect()
    found = [[] for _ in texts]
    for r in rows:
        assert r.chunk_idx == len(found[r.doc_id])
        found[r.doc_id].append(r.chunk)
    return found


def test_packing_examples(spark):
    a, b, c = "a" * 100, "b" * 100, "c" * 100
    found = packed(spark, ["\n\n".join((a, b, c)), "short text", "", "x" * 500 + "\n\ny"], 250)
    assert found == [[f"{a}\n\n{b}", c], ["short text"], [""], ["x" * 500, "y"]]


def test_packing_equals_brute_force(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(200):
        n = rng.randrange(1, 60)
        texts.append("\n\n".join(rng.choice(["", "ab", "深度", "😀x", "é" * 9, "w" * 31]) for _ in range(n)))
    for limit in (1, 10, 40):
        assert packed(spark, texts, limit) == [greedy(t.split("\n\n"), limit) for t in texts]


def test_packing_over_many_blocks(spark):
    rng = random.Random(3)
    text = "\n\n".join("p" * rng.randrange(0, 30) for _ in range(5000))
    assert packed(spark, [text], 50) == [greedy(text.split("\n\n"), 50)]


def test_reassembly_is_the_inverse(spark):
    texts = ["a\n\nb\n\n\n\nc", "", "\n\n", " x \n\n\ny"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string")
    rows = C.chunk_rows(docs, ["doc_id"], max_chars=2).repartition(5, "chunk_idx")
    whole = C.reassemble(rows, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.content for r in whole] == texts
    parts = C.reassemble_parts(rows, ["doc_id"], chunks_per_part=2).orderBy("doc_id", "part_no").collect()
    for i, text in enumerate(texts):
        assert "\n\n".join(r.content for r in parts if r.doc_id == i) == text


def test_strip_and_blank_follow_python(spark):
    texts = [c + "x y" + c for c in K.WHITESPACE] + [c for c in K.WHITESPACE]
    texts += ["", "​", " ​x​ ", "plain", "\x1c　\n a b \xa0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", T.strip(F.col("t")).alias("s"), T.is_blank(F.col("t")).alias("b")
    ).collect()
    for r in rows:
        assert r.s == r.t.strip() and r.b == (not r.t.strip()), repr(r.t)
    assert spark.range(1).select(T.is_blank(F.lit(None).cast("string"))).first()[0] is True


def test_separator_is_literal(spark):
    row = spark.range(1).select(T.split_literal(F.lit("a.*b.*"), ".*").alias("p")).first()
    assert row.p == ["a", "b", ""]


def test_language_suffix(spark):
    rows = spark.createDataFrame([(k,) for k in [*K.LANGUAGE_SUFFIX, "Klingon", None]], "l string")
    found = [r[0] for r in rows.select(T.language_suffix(F.col("l"))).collect()]
    assert found == ["zh", "en", "ja", "ja", "ko", "ko", "fr", "fr", "de", "de", "translated", "translated"]


def test_request(spark):
    prompt = T.system_prompt(K.TEXT_PROMPT, "英文")
    row = spark.range(1).select(F.to_json(T.chat_request(F.lit("hi"), prompt, "m")).alias("j")).first()
    import json

    request = json.loads(row.j)
    assert request["model"] == "m" and request["temperature"] == 0.1
    assert [m["role"] for m in request["messages"]] == ["system", "user"]
    assert "into 英文." in request["messages"][0]["content"]
    per_row = spark.createDataFrame([("X",)], "l string").select(T.system_prompt(K.BATCH_PROMPT, F.col("l"))).first()[0]
    assert per_row == K.BATCH_PROMPT.replace("{target_lang}", "X")


BATCH = "conv string, i int, text string"


def batches(spark, texts, size=3):
    rows = spark.createDataFrame([("c", i, t) for i, t in enumerate(texts)], BATCH)
    return rows, C.pack_batches(rows, ["conv"], "i", batch_size=size)


def answer(packed, response, error="boom"):
    return packed.withColumn("response", response).withColumn("error", F.lit(error))


def results(df):
    return [(r.i, r.translated, r.success, r.error, r.missing_part) for r in df.orderBy("i").collect()]


def test_batches_drop_blanks_and_keep_order(spark):
    _, packed = batches(spark, ["a", " ", "b", None, "", "　", "c"])
    rows = packed.orderBy("batch_id").collect()
    assert [r.combined for r in rows] == [f"a{K.BATCH_SEPARATOR}b", None, "c"]
    assert [r.n_sent for r in rows] == [2, 0, 1]


def test_unpack_in_order_with_blanks(spark):
    _, packed = batches(spark, ["a", " ", "b", None, "", " "])
    found = results(C.unpack_batches(answer(packed, F.upper("combined")), ["conv"], "i"))
    assert [f[1] for f in found] == ["A", "", "B", "", "", ""]
    assert all(f[2] and f[3] == "" and not f[4] for f in found)


def test_unpack_with_too_few_and_too_many_parts(spark):
    _, packed = batches(spark, ["a", "b", "c"])
    few = results(C.unpack_batches(answer(packed, F.lit(" A ")), ["conv"], "i"))
    assert [(f[1], f[2], f[4]) for f in few] == [("A", True, False), ("", True, True), ("", True, True)]
    many = F.lit(K.BATCH_SEPARATOR.join("1234"))
    assert [f[1] for f in results(C.unpack_batches(answer(packed, many), ["conv"], "i"))] == ["1", "2", "3"]


def test_lost_parts_are_found_by_length(spark):
    """Against all ways to lose as many texts, and where one way stands out."""
    import itertools
    import random

    r = random.Random(6)
    rows = []
    for i in range(300):
        sent = ["x" * r.randrange(1, 30) for _ in range(r.randrange(1, 8))]
        parts = [t + "y" * r.randrange(4) for t in sent if r.random() < 0.7] or [sent[0]]
        rows.append((i, sent, parts))
    rows += [(1000, ["a" * 5, "b" * 50, "c" * 7], ["A" * 6, "C" * 8]), (1001, ["a", "b"], ["A", "B", "C"]), (1002, ["a"] * 4, ["A"])]
    rows += [(1003, ["t" * (7 * i % 60 + 1) for i in range(80)], ["t" * (7 * i % 60 + 1) for i in range(80) if i != 41])]
    df = spark.createDataFrame(rows, "i int, sent array<string>, parts array<string>")
    got = {x.i: x.lost for x in df.select("i", C.lost_rows(F.col("sent"), F.col("parts")).alias("lost")).collect()}
    for i, sent, parts in rows[:-1]:
        n, m = len(sent), len(parts)
        ways = []
        for lost in itertools.combinations(range(n), max(0, n - m)):
            kept = [t for k, t in enumerate(sent) if k not in lost]
            ways.append((sum(abs(len(a) - len(b)) for a, b in zip(kept, parts)), [-k for k in lost]))
        assert got[i] == [-k for k in min(ways)[1]], i
    assert got[1000] == [1] and got[1001] == [] and got[1002] == [1, 2, 3] and got[1003] == [41]


def test_aligned_rows(spark):
    _, packed = batches(spark, ["short", "a very long text in the middle", " ", "words"], size=4)
    answered = answer(packed, F.lit(f"SHORT{K.BATCH_SEPARATOR}WORDS "))
    rows = C.unpack_batches(answered, ["conv"], "i", align=True).orderBy("i").collect()
    assert [(r.translated, r.missing_part, r.aligned, r.lost) for r in rows] == [
        ("SHORT", False, "SHORT", False), ("WORDS", False, "", True), ("", False, "", False), ("", True, "WORDS", False)
    ]
    failed = C.unpack_batches(answer(packed, F.lit(None).cast("string")), ["conv"], "i", align=True).collect()
    assert [(r.aligned, r.lost, r.success) for r in failed] == [("", False, False)] * 4


def test_unpack_failed_call(spark):
    _, packed = batches(spark, ["a", " ", "b"])
    found = results(C.unpack_batches(answer(packed, F.lit(None).cast("string")), ["conv"], "i"))
    assert [(f[1], f[2], f[3]) for f in found] == [("", False, "boom")] * 3


def test_every_row_gets_a_result(spark):
    rows, packed = batches(spark, ["a", "b", "c", "d"])
    some = C.unpack_batches(answer(packed, F.col("combined")), ["conv"], "i").filter("i <> 3")
    found = C.complete_results(rows, some, ["conv", "i"]).orderBy("i").collect()
    assert [(r.original, r.success, r.error) for r in found] == [
        ("a", True, ""), ("b", True, ""), ("c", True, ""), ("d", False, K.NO_RESULT_ERROR)
    ]


def test_no_rows(spark):
    rows, packed = batches(spark, [])
    assert C.unpack_batches(answer(packed, F.col("combined")), ["conv"], "i").count() == 0


def test_chunks_are_computed_once_and_without_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, content string")
    plan = C.chunk_rows(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Filter" not in plan and plan.count("split(") == 1
