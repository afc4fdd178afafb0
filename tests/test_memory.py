import pytest
from pyspark.sql import functions as F

from foliospark.operators.memory import TranslationMemory, translate_remembered
from foliospark.plans.batch import run_batch
from tests.test_batch import Calls, extractor

KEYS = ("doc_id", "chunk_idx")


def rows_of(spark, texts):
    rows = [(f"d{i}", 0, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id string, chunk_idx int, chunk string").repartition(4)


def remembered(spark, tmp_path, texts, fn, run_id, **options):
    memory = TranslationMemory(spark, f"{tmp_path}/memory")
    work = f"{tmp_path}/work-{run_id}-{options.get('target_lang', '')}"
    made = translate_remembered(
        rows_of(spark, texts), fn, memory, run_id, work, system_prompt="p", max_attempts=1, **options
    )
    return {r.doc_id: r for r in made.collect()}


def test_each_text_is_sent_once(spark, tmp_path):
    calls = Calls(tmp_path / "calls", bad="bad")
    texts = ["a", "b", "a", "bad", "bad", " ", "", None, "a"]
    found = remembered(spark, tmp_path, texts, calls, "r1")
    assert calls.sent() == ["a", "b"]
    assert [found[f"d{i}"].translated for i in range(9)] == ["T:a", "T:b", "T:a", "", "", "", "", "", "T:a"]
    assert [found[f"d{i}"].success for i in range(9)] == [True] * 3 + [False] * 2 + [True] * 4
    assert found["d3"].error == "refused bad" and not any(r.reused for r in found.values())
    assert [found[f"d{i}"].original for i in range(9)] == texts

    # The next run sends what is new and what failed.
    calls.bad = None
    found = remembered(spark, tmp_path, ["b", "bad", "c", "c"], calls, "r2")
    assert calls.sent() == ["bad", "c"]
    assert {k: r.reused for k, r in found.items()} == {"d0": True, "d1": False, "d2": False, "d3": False}
    found = remembered(spark, tmp_path, ["c", "bad", "a"], calls, "r3")
    assert calls.sent() == [] and all(r.reused and r.success for r in found.values())
    assert TranslationMemory(spark, f"{tmp_path}/memory").sent("r3", "p", "英文").count() == 0

    # Another language is another memory.
    remembered(spark, tmp_path, ["a"], calls, "r4", target_lang="中文")
    assert calls.sent() == ["a"]


def test_no_rows(spark, tmp_path):
    calls = Calls(tmp_path / "calls")
    assert remembered(spark, tmp_path, [], calls, "r1") == {}
    assert remembered(spark, tmp_path, [None, " "], calls, "r2")["d1"].success
    assert calls.sent() == []


def test_two_runs_that_sent_the_same(spark, tmp_path):
    memory = TranslationMemory(spark, f"{tmp_path}/memory")
    one = spark.createDataFrame([("k", "t", True, "")], "chunk_key string, translated string, success boolean, error string")
    one = one.select(F.sha2(F.lit("a"), 256).alias("chunk_key"), F.lit("a").alias("original"), "translated", "success", "error")
    for run in ("r1", "r2"):
        one.withColumn("translated", F.lit(run)).write.parquet(f"{memory.part('p', '英文')}/run_id={run}")
    found = remembered(spark, tmp_path, ["a", "a"], Calls(tmp_path / "calls"), "r3")
    assert {r.translated for r in found.values()} == {"r2"} and len(found) == 2


def test_hot_text(spark, tmp_path):
    """A text that holds a third of all rows is sent once and reaches every row."""
    calls = Calls(tmp_path / "calls")
    texts = [("hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    found = remembered(spark, tmp_path, texts, calls, "r1", texts_per_call=100)
    assert len(calls.sent()) == 2001 and all(found[f"d{i}"].translated == f"T:{t}" for i, t in enumerate(texts))


@pytest.mark.parametrize("memory", [False, True])
def test_runs_with_and_without(spark, tmp_path, memory):
    """The same documents come out; with a memory copies cost nothing and retries only what failed."""
    calls = Calls(tmp_path / "calls", bad="ugly")
    contents = ["same\n\nsame", "same", "ugly", "x\n\nugly", " "]
    manifest = spark.range(len(contents)).select(
        F.concat(F.lit("d"), "id").alias("doc_id"), F.concat(F.lit("/in/"), "id").alias("path"),
        F.col("id").cast("string").alias("file"), F.col("id").cast("string").alias("stem"),
        F.lit("2024-01-01").cast("timestamp").alias("mtime"),
        F.to_json(F.struct(F.get(F.array(*map(F.lit, contents)), F.col("id").cast("int")).alias("markdown")))
        .cast("binary").alias("content"),
    )

    def run():
        options = {"memory": f"{tmp_path}/memory"} if memory else {}
        done = run_batch(
            spark, manifest, f"{tmp_path}/out", extractor, calls, content="content", max_attempts=1, max_chars=4,
            **options,
        )
        rows = spark.read.parquet(done.tables.path("translated_markdown", done.run_id)).collect()
        return {r.doc_id: (r.content, r.n_failed_chunks) for r in rows}

    first = {"d0": ("T:same\n\nT:same", 0), "d1": ("T:same", 0), "d2": ("ugly", 1), "d3": ("T:x\n\nugly", 1)}
    assert run() == first
    assert calls.sent() == (["same", "x"] if memory else ["same", "same", "same", "x"])
    calls.bad = None
    assert run() == {"d2": ("T:ugly", 0), "d3": ("T:x\n\nT:ugly", 0)}
    assert calls.sent() == (["ugly"] if memory else ["ugly", "ugly"])
