import json
import os

import pytest
from pyspark.sql import functions as F

from foliospark.plans.batch import run_files
from foliospark.streaming.markdown import translate_new_files

FAST = {"parallelism": 4, "max_attempts": 1}


def extractor(path, content):
    """A source file of these tests holds its own layout and Markdown."""
    body = json.loads(content)
    if body.get("unreadable"):
        raise ValueError("unreadable file")
    return body.get("layout", [{"type": "text", "text": "x", "page_idx": 0}]), body.get("markdown")


class Calls:
    """Counts calls across worker processes by appending to a file."""

    def __init__(self, path, bad=None):
        self.path, self.bad = str(path), bad

    def __call__(self, texts, prompt):
        bad = self.bad
        if bad and any(bad in t for t in texts):
            if len(texts) > 1 or bad in texts[0]:
                raise RuntimeError(f"refused {bad}")
        with open(self.path, "a") as log:
            for t in texts:
                log.write(t.replace("\n", "|") + "\n")
        return [f"T:{t}" for t in texts]

    def sent(self):
        lines = open(self.path).read().splitlines() if os.path.exists(self.path) else []
        if os.path.exists(self.path):
            open(self.path, "w").close()
        return sorted(lines)


def put(folder, name, when=1000, **body):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(body))
    os.utime(path, (when, when))


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "in"
    put(folder, "good one.pdf", markdown="# A\n\nbody")
    put(folder, "sub/good one.pdf", markdown="other")
    put(folder, "unreadable.pdf", unreadable=True)
    put(folder, "badlayout.pdf", layout="[oops", markdown="never")
    put(folder, "nomarkdown.pdf")
    put(folder, "blank.pdf", markdown=" \n")
    put(folder, "empty.pdf", layout=[], markdown="text of empty")
    return folder


def run(spark, inputs, out, translator=None, **options):
    return run_files(spark, str(inputs), str(out), extractor, True, translator=translator, **FAST, **options)


def details(done):
    return {os.path.relpath(r.path, os.path.dirname(r.path) + "/.." if "/sub/" in r.path else os.path.dirname(r.path)): r for r in done.details.collect()}


def outcomes(done):
    return {k: (r.success, r.outcome, r.stages_run) for k, r in details(done).items()}


def test_first_run_and_rerun(spark, inputs, tmp_path):
    out, calls = tmp_path / "out", Calls(tmp_path / "calls")
    first = run(spark, inputs, out, calls)
    assert outcomes(first) == {
        "good one.pdf": (True, "success", 3),
        "sub/good one.pdf": (True, "success", 3),
        "unreadable.pdf": (False, "failed", 1),
        "badlayout.pdf": (False, "failed", 2),
        "nomarkdown.pdf": (True, "skipped", 2),
        "blank.pdf": (True, "skipped", 2),
        "empty.pdf": (True, "success", 3),
    }
    assert details(first)["unreadable.pdf"].error == "unreadable file"
    assert calls.sent() == ["# A||body", "other", "text of empty"]
    assert first.totals.first().asDict() == {"total": 7, "success": 3, "skipped": 2, "failed": 2, "ok": False}
    summary = next((out / f"batch_summary/run_id={first.run_id}").glob("*.json")).read_text()
    assert json.loads(summary)["total"] == 7
    texts = spark.read.parquet(first.tables.path("translated_markdown", first.run_id))
    assert sorted((r.out_name, r.content) for r in texts.collect()) == [
        ("empty_en.md", "T:text of empty"), ("good one_en.md", "T:# A\n\nbody"), ("good one_en.md", "T:other")
    ]
    summaries = spark.read.parquet(first.tables.path("layout_summary", first.run_id))
    assert summaries.filter("success and total_elements = 0").count() == 1

    # Nothing changed: finished stages stay, unfinished ones are tried again.
    second = run(spark, inputs, out, calls)
    assert calls.sent() == []
    assert {k: v[2] for k, v in outcomes(second).items()} == {
        "good one.pdf": 0, "sub/good one.pdf": 0, "empty.pdf": 0, "unreadable.pdf": 1, "badlayout.pdf": 1,
        "nomarkdown.pdf": 0, "blank.pdf": 0,
    }

    # A changed source runs through all stages, a repaired one goes on.
    put(inputs, "good one.pdf", when=2000, markdown="# B")
    put(inputs, "unreadable.pdf", markdown="fixed")
    third = run(spark, inputs, out, calls)
    assert calls.sent() == ["# B", "fixed"]
    ran = {k: v[2] for k, v in outcomes(third).items()}
    assert ran["good one.pdf"] == 3 and ran["unreadable.pdf"] == 3 and ran["sub/good one.pdf"] == 0

    # Another language translates everything and parses nothing, also from a compacted state.
    third.tables.compact()
    assert third.tables.events(third.tables.state_version()).count() == 7 * 3 - 1
    fourth = run(spark, inputs, out, calls, target_lang="中文")
    assert calls.sent() == ["# B", "fixed", "other", "text of empty"]
    assert outcomes(fourth)["good one.pdf"] == (True, "success", 1)


def test_only_failed_chunks_are_sent_again(spark, tmp_path):
    inputs, out = tmp_path / "in", tmp_path / "out"
    put(inputs, "a.pdf", markdown="one\n\nbad\n\nthree")
    calls = Calls(tmp_path / "calls", bad="bad")
    first = run(spark, inputs, out, calls, max_chars=3)
    row = details(first)["a.pdf"]
    assert (row.success, row.outcome, row.error) == (False, "failed", "1 chunks failed")
    assert calls.sent() == ["one", "three"]
    text = spark.read.parquet(first.tables.path("translated_markdown", first.run_id)).first()
    assert (text.content, text.n_failed_chunks) == ("T:one\n\nbad\n\nT:three", 1)

    calls.bad = None
    second = run(spark, inputs, out, calls, max_chars=3)
    assert calls.sent() == ["bad"]
    assert outcomes(second)["a.pdf"] == (True, "success", 1)
    text = spark.read.parquet(second.tables.path("translated_markdown", second.run_id)).first()
    assert text.content == "T:one\n\nT:bad\n\nT:three"


def test_compaction_keeps_what_running_runs_add(spark, inputs, tmp_path):
    """A run that began before the compaction and marks a stage after it."""
    from foliospark.operators import state as S

    done = run(spark, inputs, tmp_path / "out")
    tables = done.tables
    docs = done.details.filter("path LIKE '%unreadable.pdf'").withColumn("mtime", S.F.current_timestamp())
    tables.append_events(S.mark_stage(docs, "parse", "done", "0-early"), "0-early")
    tables.compact()
    tables.append_events(S.mark_stage(docs, "layout", "done", "0-early"), "0-early")
    tables.compact()
    tables.append_events(S.mark_stage(docs, "translate", "done", "0-early", target_lang="英文"), "0-early")
    state = S.latest_state(tables.events(tables.state_version()), "英文").join(docs.select("doc_id"), "doc_id")
    row = state.first()
    assert [row[s].status for s in ("parse", "layout", "translate")] == ["done"] * 3


def test_lists_of_appends_are_bounded(spark, tmp_path):
    """After a vacuum a compacted state lists only the appends that are left, and holds all of them."""
    from datetime import datetime, timedelta, timezone

    from foliospark.operators import state as S
    from foliospark.plans.batch import Tables, new_run_id

    tables = Tables(spark, str(tmp_path / "out"))
    docs = spark.createDataFrame([(f"d{i}",) for i in range(3)], "doc_id string").withColumn(
        "mtime", F.lit("2024-01-01").cast("timestamp")
    )
    assert tables.vacuum(datetime.now(timezone.utc)) == 0
    for stage in ("parse", "layout"):
        for _ in range(3):
            run_id = new_run_id()
            tables.append_events(S.mark_stage(docs, stage, "done", run_id), run_id)
        version = tables.compact()
    assert len(tables._covered(version)) == 6
    assert tables.vacuum(datetime.now(timezone.utc) - timedelta(days=1)) == 0
    running = new_run_id()
    assert tables.vacuum(datetime.now(timezone.utc)) == 7 and tables._appends() == []
    tables.append_events(S.mark_stage(docs, "translate", "done", running, target_lang="英文"), running)
    (tmp_path / "out/stage_events/append=broken").mkdir()  # never committed
    state = S.latest_state(tables.events(tables.state_version()), "英文").collect()
    assert len(state) == 3 and all(r[s].status == "done" for r in state for s in ("parse", "layout", "translate"))
    version = tables.compact()
    assert len(tables._covered(version)) == 1 and tables.events(version).count() == 9
    assert tables.events(only_run=running).count() == 3


def test_exports_and_system_prompt(spark, inputs, tmp_path):
    def echo(texts, prompt):
        return [f"{prompt}:{t}" for t in texts]

    done = run(
        spark, inputs, tmp_path / "out", echo, system_prompt="mine", export_to=f"file://{tmp_path}/md"
    )
    found = sorted(p.read_text(encoding="utf-8-sig") for p in (tmp_path / "md").rglob("*.md"))
    assert found == ["mine:# A\n\nbody", "mine:other", "mine:text of empty"]
    assert done.totals.first().success == 3


def test_no_raw_document_is_shuffled(spark, tmp_path):
    """Neither on a first run nor on a rerun does an exchange carry the documents or texts."""
    from pyspark.sql import functions as F

    from foliospark.plans import batch

    plans = []
    write = batch.Tables.write

    def watched(self, df, table, run_id):
        plans.append((table, df._jdf.queryExecution().executedPlan().toString()))
        return write(self, df, table, run_id)

    manifest = spark.range(50).select(
        F.concat(F.lit("d"), "id").alias("doc_id"), F.concat(F.lit("/in/"), "id").alias("path"),
        F.col("id").cast("string").alias("file"), F.col("id").cast("string").alias("stem"),
        F.lit("2024-01-01").cast("timestamp").alias("mtime"),
        F.encode(F.concat(F.lit('{"markdown": "m'), "id", F.lit('"}')), "utf-8").alias("content"),
    )
    path = str(tmp_path / "docs")
    manifest.write.parquet(path)
    batch.Tables.write = watched
    try:
        for when in ("2024-01-01", "2024-01-02"):
            docs = spark.read.parquet(path).withColumn("mtime", F.lit(when).cast("timestamp"))
            done = batch.run_batch(
                spark, docs, str(tmp_path / "out"), extractor, lambda t, p: t, content="content", max_attempts=1
            )
            assert done.totals.first().success == 50
            assert done.details.agg(F.min("stages_run")).first()[0] == 3
    finally:
        batch.Tables.write = write
    for table, plan in plans:
        if table in ("extracted", "answers", "translated_chunks", "translated_markdown"):
            assert "Exchange hashpartitioning" not in plan and "Exchange Round" not in plan, (table, plan)


def test_without_translation(spark, tmp_path):
    inputs, out, calls = tmp_path / "in", tmp_path / "out", Calls(tmp_path / "calls")
    put(inputs, "a.pdf", markdown="text")
    assert outcomes(run(spark, inputs, out))["a.pdf"] == (True, "skipped", 2)
    assert outcomes(run(spark, inputs, out, calls))["a.pdf"] == (True, "success", 1)
    # Switching translation off again does not undo what is done.
    assert outcomes(run(spark, inputs, out))["a.pdf"] == (True, "success", 0)
    run(spark, inputs, out, calls)
    assert calls.sent() == ["text"]


def test_lost_output_fails_the_document(spark, tmp_path):
    import shutil

    inputs, out = tmp_path / "in", tmp_path / "out"
    put(inputs, "a.pdf", layout="[oops", markdown="text")
    first = run(spark, inputs, out)
    shutil.rmtree(out / f"extracted/run_id={first.run_id}")
    put(inputs, "b.pdf", markdown="text")
    found = details(run(spark, inputs, out))
    assert found["a.pdf"].success is False and "missing" in found["a.pdf"].error
    assert found["b.pdf"].success is True


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError):
        run(spark, tmp_path / "in", tmp_path / "out")


def test_refused_chunks_do_not_stop_others(spark, tmp_path):
    """Thirty refused chunks stand in front of good ones, in the batch run and in the stream."""
    text = "\n\n".join([*["ugly"] * 30, "good"])
    inputs, folder, out = tmp_path / "in", tmp_path / "md", tmp_path / "stream"
    put(inputs, "a.pdf", markdown=text)
    put(inputs, "b.pdf", markdown="fine")
    calls = Calls(tmp_path / "calls", bad="ugly")
    done = run_files(
        spark, str(inputs), str(tmp_path / "out"), extractor, True, translator=calls, parallelism=1, max_attempts=1,
        max_chars=4, in_flight=2,
    )
    assert calls.sent() == ["fine", "good"]
    rows = spark.read.parquet(done.tables.path("translated_markdown", done.run_id)).collect()
    assert sorted(r.n_failed_chunks for r in rows) == [0, 30]
    folder.mkdir()
    (folder / "a.md").write_text(text)
    (folder / "b.md").write_text("fine")
    query = translate_new_files(
        spark, f"file://{folder}", str(out), str(tmp_path / "ck"), calls, max_attempts=1, max_chars=4, parallelism=1
    )
    assert query.awaitTermination(120) and calls.sent() == ["fine", "good"]
    assert sorted(r.n_failed_chunks for r in spark.read.parquet(str(out)).collect()) == [0, 30]


def test_stream_runs_a_batch_again_when_the_service_was_down(spark, tmp_path):
    folder, out = tmp_path / "md", tmp_path / "out"
    folder.mkdir()
    for i in range(6):
        (folder / f"{i}.md").write_text(f"text {i}")
    calls = Calls(tmp_path / "calls", bad="text")

    def once():
        query = translate_new_files(
            spark, f"file://{folder}", str(out), str(tmp_path / "ck"), calls, max_attempts=1, parallelism=1, stop_after=3
        )
        query.awaitTermination(120)

    with pytest.raises(Exception, match="3 texts in a row failed"):
        once()
    assert not list(out.glob("batch_id=*/part-*"))
    calls.bad = None
    once()
    assert calls.sent() == [f"text {i}" for i in range(6)]
    assert spark.read.parquet(str(out)).count() == 6


def test_new_files_stream(spark, tmp_path):
    folder, out = tmp_path / "md", tmp_path / "out"
    folder.mkdir()
    calls = Calls(tmp_path / "calls")

    def once():
        query = translate_new_files(
            spark, f"file://{folder}", str(out), str(tmp_path / "ck"), calls, max_attempts=1
        )
        assert query.awaitTermination(120)
        return sorted((r.out_name, r.content) for r in spark.read.parquet(str(out)).collect())

    (folder / "a.md").write_text("﻿# A\n\nb")
    (folder / "skip.txt").write_text("no")
    assert once() == [("a_en.md", "T:# A\n\nb")]
    (folder / "b.md").write_text("two")
    assert once() == [("a_en.md", "T:# A\n\nb"), ("b_en.md", "T:two")]
    assert calls.sent() == ["# A||b", "two"]
