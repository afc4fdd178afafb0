import threading
import time

import pytest
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.operators import calls
from foliospark.operators import translate as TR
from foliospark.operators.calls import Caller, Calling, ServiceDown, attempt
from foliospark.operators.skew import join_one_per_key
from foliospark.session import shared_path


def prefix(texts, prompt):
    return [f" [translated]{t}\n" for t in texts]


def refuse(texts, prompt):
    raise RuntimeError("service down")


def refuse_some(texts, prompt):
    if any("bad" in t for t in texts):
        raise RuntimeError("bad text")
    return prefix(texts, prompt)


CHUNKS = "doc_id string, chunk_idx int, chunk string"


def table(spark, *chunks):
    return spark.createDataFrame([("d", i, c) for i, c in enumerate(chunks)], CHUNKS)


def test_results(spark):
    rows = TR.translate_table(table(spark, "one", " ", "two"), prefix).orderBy("chunk_idx").collect()
    assert [(r.original, r.translated, r.success, r.error) for r in rows] == [
        ("one", "[translated]one", True, ""), (" ", "", True, ""), ("two", "[translated]two", True, "")
    ]
    assert {r.target_lang for r in rows} == {K.DEFAULT_TARGET_LANG}


def test_a_bad_text_does_not_fail_its_neighbours(spark):
    rows = TR.translate_table(table(spark, "one", "bad", "two"), refuse_some, max_attempts=1).orderBy("chunk_idx").collect()
    assert [(r.translated, r.success, r.error) for r in rows] == [
        ("[translated]one", True, ""), ("", False, "bad text"), ("[translated]two", True, "")
    ]


def test_good_texts_behind_many_refused_ones(spark):
    """In one task, row by row and as a document, also with calls that overlap."""
    texts = ["bad"] * 25 + ["good"] * 5
    for options in ({}, {"in_flight": 3}, {"texts_per_call": 4}):
        rows = TR.translate_table(table(spark, *texts).coalesce(1), refuse_some, max_attempts=1, **options)
        assert rows.filter("success").count() == 5
        docs = spark.createDataFrame([("d", "\n\n".join(texts)), ("e", "good")], "doc_id string, content string")
        made = TR.translate_markdown(docs.coalesce(1), refuse_some, max_chars=1, max_attempts=1, **options).collect()
        assert {r.doc_id: r.n_failed_chunks for r in made} == {"d": 25, "e": 0}


def test_attempts():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("later")
        return "ok"

    waits = []
    assert attempt(flaky, 3, lambda n: waits.append(n) or 0) == ("ok", None)
    assert waits == [1, 2]
    calls.clear()
    assert attempt(flaky, 2, lambda n: 0) == (None, "later")
    calls.clear()
    assert attempt(flaky, 0, lambda n: 0) == (None, "later") and len(calls) == 1


def answers(fn, texts, prompt="", **options):
    return Caller(fn, prompt, Calling(**{"attempts": 1, "backoff": 0, **options})).answers(texts)


def test_answers_of_the_wrong_number_or_kind():
    assert answers(lambda t, p: [], ["a"]) == [(None, "0 answers to 1 texts")]
    assert answers(lambda t, p: [None for _ in t], ["a"]) == [(None, "no answer")]
    assert answers(refuse, ["", None, " "]) == [(None, None)] * 3
    assert answers(lambda t, p: [p] * len(t), ["a"], "prompt") == [("prompt", None)]


def test_calls_are_bounded():
    sizes = []

    def some(texts, prompt):
        sizes.append(len(texts))
        if "bad" in texts:
            raise ValueError("no")
        return texts

    texts = [str(i) for i in range(9)]
    assert answers(some, texts, texts_per_call=4) == [(t, None) for t in texts]
    assert sizes == [4, 4, 1]
    # A failing call is halved down to the text at fault.
    sizes.clear()
    assert answers(some, ["0", "1", "bad", "3"], texts_per_call=4)[2] == (None, "no")
    assert sizes == [4, 2, 2, 1, 1]
    # Every text is sent, however many before it have failed.
    sizes.clear()
    assert answers(some, ["bad"] * 50 + ["good"])[-1] == ("good", None) and len(sizes) == 51


@pytest.mark.parametrize("in_flight", [1, 4])
def test_a_service_that_is_down_ends_the_job_if_asked_to(in_flight):
    asked = []

    def down(texts, prompt):
        asked.append(texts)
        raise ConnectionError("down")

    with pytest.raises(ServiceDown, match="down"):
        answers(down, ["x"] * 500, stop_after=3, in_flight=in_flight)
    assert len(asked) <= 3 + in_flight
    # Refusing texts is an answer, and a good one in between starts the count anew.
    assert {e for _, e in answers(lambda t, p: [ValueError("no")] * len(t), ["x"] * 50, stop_after=3)} == {"no"}
    found = answers(refuse_some, ["bad", "bad", "x"] * 20, stop_after=3, in_flight=in_flight)
    assert sum(e is None for _, e in found) == 20


def test_calls_overlap_and_keep_their_order():
    running, most, lock = [0], [0], threading.Lock()

    def slow(texts, prompt):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.002 if "0" in texts[0] else 0.02)
        with lock:
            running[0] -= 1
        if texts[0].endswith("7"):
            raise ValueError(texts[0])
        return [f"T{t}" for t in texts]

    texts = [str(i) for i in range(60)] + [None, " "]
    began = time.perf_counter()
    plain = answers(slow, texts)
    middle = time.perf_counter()
    assert most == [1] and answers(slow, texts, in_flight=6) == plain
    assert 3 <= most[0] <= 6 and time.perf_counter() - middle < (middle - began) / 2
    assert [p for p in plain if p[1]] == [(None, str(i)) for i in range(7, 60, 10)]


def test_prompts(spark):
    def echo(texts, prompt):
        return [prompt for _ in texts]

    plain = TR.translate_single(table(spark, "x"), echo, "Latin").first().translated
    assert plain == K.TEXT_PROMPT.replace("{target_lang}", "Latin")
    markdown = TR.translate_table(table(spark, "x"), echo, "Latin").first().translated
    assert markdown == K.MARKDOWN_PROMPT.replace("{target_lang}", "Latin")
    own = TR.translate_table(table(spark, "x"), echo, system_prompt="mine").first().translated
    assert own == "mine"


def document(spark, text, fn, **options):
    docs = spark.createDataFrame([("d", text)], "doc_id string, content string")
    return TR.translate_markdown(docs, fn, max_attempts=1, **options).first()


def test_markdown(spark):
    assert document(spark, "north\n\nsouth\n\neast", prefix, max_chars=10).content == (
        "[translated]north\n\nsouth\n\n[translated]east"
    )
    whole = document(spark, "north\n\nsouth", prefix)
    assert (whole.content, whole.n_chunks) == ("[translated]north\n\nsouth", 1)
    refused = document(spark, "left\n\nas it was", refuse, max_chars=4)
    assert (refused.content, refused.n_failed_chunks) == ("left\n\nas it was", 2)


@pytest.mark.parametrize("text", ["", " \n　", None])
def test_blank_markdown_comes_back_unchanged(spark, text):
    row = document(spark, text, refuse)
    assert (row.content, row.n_chunks, row.n_failed_chunks) == (text, 0, 0)


def test_blank_chunks_become_empty(spark):
    row = document(spark, "aaa\n\n   \n\nbbb", prefix, max_chars=2)
    assert row.content == "[translated]aaa\n\n\n\n[translated]bbb"


def test_identity_translation_strips_chunks(spark):
    row = document(spark, " a \n\nb ", lambda t, p: t, max_chars=1)
    assert row.content == "a\n\nb"


def test_markdown_needs_no_shuffle(spark):
    docs = spark.createDataFrame([("d", "x")], "doc_id string, content string")
    plan = TR.translate_markdown(docs, prefix)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("split(") == 1


def test_fallback(spark):
    chunks = table(spark, "a", "b", "c")
    results = spark.createDataFrame(
        [("d", 0, "A", True), ("d", 1, "", False)], "doc_id string, chunk_idx int, translated string, success boolean"
    )
    rows = TR.apply_results(chunks, results, ("doc_id", "chunk_idx")).orderBy("chunk_idx").collect()
    assert [(r.final, r.fell_back) for r in rows] == [("A", False), ("b", True), ("c", True)]


def test_distinct_texts_are_sent_once(spark):
    chunks = spark.range(900).select(
        F.col("id").cast("string").alias("doc_id"), F.lit(0).alias("chunk_idx"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, " ").otherwise(F.concat(F.lit("t"), "id")).alias("chunk"),
    )
    path = shared_path(spark, "distinct")
    rows = TR.translate_distinct(chunks, prefix, path)
    assert rows.count() == 900
    assert spark.read.parquet(f"{path}/results").count() == 302
    expected = TR.translate_table(chunks, prefix).select(rows.columns)
    assert rows.exceptAll(expected).count() == 0 and expected.exceptAll(rows).count() == 0


def test_null_texts_in_distinct(spark):
    rows = TR.translate_distinct(table(spark, None, "", "x"), prefix, shared_path(spark, "nulls")).orderBy("chunk_idx").collect()
    assert [(r.original, r.translated, r.success) for r in rows] == [(None, "", True), ("", "", True), ("x", "[translated]x", True)]


def test_distinct_texts_are_hashed_not_sorted(spark):
    chunks = table(spark, "a", "b")
    keyed = chunks.select(F.sha2("chunk", 256).alias("text_key"), F.col("chunk").alias("original"))
    plan = keyed.distinct()._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_hot_keys_are_dealt_to_salts(spark):
    many = spark.range(1000).select("id", F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    one = many.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.upper("k"))
    rows = join_one_per_key(many, one, "k", ["id"], salts=16).collect()
    assert len(rows) == 1000 and len({r.id for r in rows}) == 1000
    assert all(r.v == r.k.upper() and r.n == (700 if r.k == "hot" else 1) for r in rows)
    missing = join_one_per_key(many, one.filter("k != 'hot'"), "k", ["id"]).filter("v is null")
    assert missing.count() == 700


def test_answers_go_out_in_slices():
    """Python holds the texts of one slice, whatever the size of the batch; answers stay with their texts."""
    import pyarrow as pa

    texts = [f"{i}" * 40_000 if i % 5 else None for i in range(100)]
    lists = [None if i % 7 == 0 else [t, str(i)] if t else [] for i, t in enumerate(texts)]
    batch = pa.record_batch({"id": list(range(100)), "t": texts, "l": pa.array(lists, pa.list_(pa.string()))})
    calling = calls.Calling(1, 1.0, texts_per_call=3)
    fn = lambda texts, prompt: [t[::-1] for t in texts]
    found = list(calls.answer_column(fn, "", "t", calling)([batch.slice(0, 50), batch.slice(50)]))
    assert len(found) > 3 and sum((b["id"].to_pylist() for b in found), []) == list(range(100))
    assert sum((b["response"].to_pylist() for b in found), []) == [t and t[::-1] for t in texts]
    found = list(calls.answer_lists(fn, "", "l", calling)([batch.slice(0, 50), batch.slice(50)]))
    answers = sum((b["answers"].to_pylist() for b in found), [])
    assert len(found) > 3 and sum((b["id"].to_pylist() for b in found), []) == list(range(100))
    assert [a and [x["response"] for x in a] for a in answers] == [x and [t[::-1] for t in x] for x in lists]
