from pyspark.sql import functions as F

from foliospark.plans import views
from tests.test_batch import Calls, inputs, put, run  # noqa: F401


def by_stem(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_each_document_from_the_run_that_holds_it(spark, inputs, tmp_path):  # noqa: F811
    out, calls = tmp_path / "out", Calls(tmp_path / "calls", bad="other")
    first = run(spark, inputs, out, calls)
    tables = first.tables
    assert by_stem(views.current_translations(tables), "stem", "content", "n_failed_chunks") == [
        ("empty", "T:text of empty", 0), ("good one", "T:# A\n\nbody", 0), ("good one", "other", 1)
    ]
    # Documents without elements have a summary; those whose layout failed have none.
    assert views.current_summaries(tables).count() == 5
    assert views.current_summaries(tables).filter("total_elements = 0").count() == 1
    assert views.current_elements(tables).count() == 4

    calls.bad = None
    put(inputs, "good one.pdf", when=2000, markdown="# B", layout=[{"type": "title"}, {"type": "text"}])
    put(inputs, "empty.pdf", when=2000, layout="[oops", markdown="never")
    second = run(spark, inputs, out, calls)
    tables.compact()
    run_no = F.when(F.col("run_id") == first.run_id, 1).when(F.col("run_id") == second.run_id, 2)
    texts = views.current_translations(tables).withColumn("run_no", run_no)
    # What the changed document's last translation was stays current, since it was not tried again.
    assert by_stem(texts, "stem", "run_no", "content") == [
        ("empty", 1, "T:text of empty"), ("good one", 2, "T:# B"), ("good one", 2, "T:other")
    ]
    summaries = views.current_summaries(tables).withColumn("run_no", run_no)
    assert by_stem(summaries, "run_no", "total_elements") == [(1, 1), (1, 1), (1, 1), (2, 2)]
    assert by_stem(views.current_elements(tables).withColumn("run_no", run_no), "run_no", "element_type") == [
        (1, "text"), (1, "text"), (1, "text"), (2, "text"), (2, "title")
    ]
    assert views.current_translations(tables, "中文").count() == 0


def test_runs_without_current_results_are_not_read(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    put(folder, "a.pdf", markdown="one")
    first = run(spark, folder, out)
    put(folder, "a.pdf", when=2000, markdown="two")
    run(spark, folder, out)
    df = views.current_elements(first.tables)
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "Exchange hashpartitioning" not in plan
    assert df.filter(F.col("run_id") == first.run_id).count() == 0


def test_nothing_was_run(spark, tmp_path):
    from foliospark.plans.batch import Tables

    tables = Tables(spark, str(tmp_path / "out"))
    assert views.current_elements(tables).count() == views.current_translations(tables).count() == 0
