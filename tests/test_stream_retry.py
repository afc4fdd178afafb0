import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from foliospark.plans.queries import stream_retries
from foliospark.session import shuffles_freed
from foliospark.sources import tables
from foliospark.streaming.markdown import retry_failed, translate_new_files, translated_documents
from tests.test_batch import Calls


def test_failed_chunks_are_taken_along(spark, tmp_path):
    folder, out, memory = tmp_path / "md", str(tmp_path / "out"), str(tmp_path / "memory")
    folder.mkdir()
    calls = Calls(tmp_path / "calls", bad="ugly")
    options = {"max_attempts": 1, "max_chars": 4}

    def once():
        query = translate_new_files(
            spark, f"file://{folder}", out, str(tmp_path / "ck"), calls, memory=memory, **options
        )
        assert query.awaitTermination(200)

    def found():
        return {r.stem: (r.content, r.n_failed_chunks) for r in translated_documents(spark, out).collect()}

    (folder / "a.md").write_text("good\n\nugly")
    (folder / "b.md").write_text("good")
    (folder / "c.md").write_text(" \n")
    once()
    assert calls.sent() == ["good"]
    assert found() == {"a": ("T:good\n\nugly", 1), "b": ("T:good", 0), "c": (" \n", 0)}

    # The next batch sends what failed, and nothing that did not.
    (folder / "d.md").write_text("ugly\n\nnew")
    calls.bad = "new"
    once()
    assert calls.sent() == ["ugly"]
    assert found()["a"] == ("T:good\n\nT:ugly", 0) and found()["d"] == ("T:ugly\n\nnew", 1)

    # So does a retry without new files; a second one has nothing to do.
    assert retry_failed(spark, out, calls, memory, **options) == 1 and calls.sent() == []
    calls.bad = None
    assert retry_failed(spark, out, calls, memory, **options) == 1 and calls.sent() == ["new"]
    assert retry_failed(spark, out, calls, memory, **options) == 0
    want = {"a": ("T:good\n\nT:ugly", 0), "b": ("T:good", 0), "c": (" \n", 0), "d": ("T:ugly\n\nT:new", 0)}
    assert found() == want

    # A batch that is run again, as after a crash, costs no calls and leaves the same rows.
    commits = sorted((p for p in (tmp_path / "ck/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    (tmp_path / f"ck/commits/.{commits[-1].name}.crc").unlink(missing_ok=True)
    once()
    assert calls.sent() == [] and found() == want
    (folder / "e.md").write_text("last")
    once()
    assert calls.sent() == ["last"] and found() == {**want, "e": ("T:last", 0)}


def test_nothing_waits(spark, tmp_path):
    (tmp_path / "md").mkdir()
    (tmp_path / "md/a.md").write_text("x")
    out, memory = str(tmp_path / "out"), str(tmp_path / "memory")
    query = translate_new_files(
        spark, f"file://{tmp_path}/md", out, str(tmp_path / "ck"), Calls(tmp_path / "calls"), memory=memory
    )
    assert query.awaitTermination(200)
    assert retry_failed(spark, out, Calls(tmp_path / "calls"), memory) == 0
    assert translated_documents(spark, out).count() == 1


def test_arrivals_are_noted(spark, tmp_path):
    """One note for each micro-batch, so that a batch is not listed file by file again; hidden and empty files."""
    (tmp_path / "md").mkdir()
    for i in range(7):
        (tmp_path / f"md/{i}.md").write_text(f"x{i}")
    for name, text in ((".h.md", "no"), ("_h.md", "no"), ("e.md", ""), ("t.txt", "no")):
        (tmp_path / "md" / name).write_text(text)
    out, checkpoint, calls = str(tmp_path / "out"), str(tmp_path / "ck"), Calls(tmp_path / "calls")

    def once(**options):
        query = translate_new_files(spark, f"file://{tmp_path}/md", out, checkpoint, calls, max_files_per_batch=3, **options)
        assert query.awaitTermination(200)

    once()
    assert calls.sent() == [f"x{i}" for i in range(7)]
    assert len(list((tmp_path / "ck/arrivals").glob("*/batch=*/part-*.parquet"))) == 3
    assert spark.read.parquet(out).groupBy("batch_id").count().count() == 3
    (tmp_path / "md/new.md").write_text("new")
    once()
    assert calls.sent() == ["new"] and spark.read.parquet(out).count() == 8
    once()
    assert calls.sent() == []
    with pytest.raises(ValueError, match="available_now"):
        once(available_now=False)


def below(path):
    """Files by name, without checksums and marks of a written table."""
    found = (os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f[0] not in "._")
    return [f.removeprefix(f"{path}/") for f in found]


def test_what_a_batch_needs_goes_with_it(spark, tmp_path):
    """Files of taken documents and work tables do not add up over the batches."""
    spark.range(9).selectExpr("id AS doc_id", "'en' AS lang", "repeat(concat('word', id % 5, ' Fuß\n'), 900) AS text").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    kept = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(kept))
    rows = stream_retries(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(9)) and {r.n_failed_chunks for r in rows} == {0}
    new = [d for d in os.listdir(kept) if d not in before]
    assert not [d for d in new if d.startswith(("stream-batch", "retry-files", "retry-state"))]
    assert not [f for d in new for f in below(f"{kept}/{d}") if f.endswith(".md")]


def test_shuffles_go_with_their_query(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def left(name):
        before, found = disk.getAllFiles().size(), None
        spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/{name}")
        for _ in range(50):
            if (found := disk.getAllFiles().size()) <= before:
                break
            time.sleep(0.1)
        return max(0, found - before)

    was = spark.conf.get(key, None)
    with shuffles_freed(spark):
        assert left("freed") == 0
    assert spark.conf.get(key, None) == was


def test_taken_files(spark, tmp_path):
    """A batch that fails after its files are deleted goes by their table when it is run again."""
    (tmp_path / "md").mkdir()
    for i in range(6):
        (tmp_path / f"md/{i}.md").write_text(f"x{i}\n\nbad")
    (tmp_path / "md/t.txt").write_text("stays")
    out, memory, calls = str(tmp_path / "out"), str(tmp_path / "memory"), Calls(tmp_path / "calls", bad="bad")
    options = {"max_attempts": 1, "max_chars": 3}

    def once(**more):
        query = translate_new_files(
            spark, f"file://{tmp_path}/md", out, str(tmp_path / "ck"), calls, max_files_per_batch=4, memory=memory,
            take=True, **options, **more,
        )
        assert query.awaitTermination(200)

    with pytest.raises(StreamingQueryException):
        once(stop_after=1)
    assert len(below(tmp_path / "md")) == 3 and not os.path.exists(out)
    once()
    assert below(f"{tmp_path}/md") == ["t.txt"] and os.listdir(tmp_path / "ck/taken") == ["1"]
    rows = translated_documents(spark, out).collect()
    assert {r.stem: (r.content, r.n_failed_chunks) for r in rows} == {str(i): (f"T:x{i}\n\nbad", 1) for i in range(6)}
    calls.bad = None
    assert retry_failed(spark, out, calls, memory, **options) == 6
    rows = translated_documents(spark, out).collect()
    assert sorted((r.stem, r.content) for r in rows) == [(str(i), f"T:x{i}\n\nT:bad") for i in range(6)]


def test_slices(spark, tmp_path, monkeypatch):
    """The same documents come out of many slices, which send a text once, and one that fails once as well."""
    monkeypatch.setattr(tables, "SLICE_BYTES", (1, 1))
    spark.range(6).repartition(3).selectExpr("concat('d', id) doc_id", "concat('s', id) stem", "concat('x', id % 2, '\n\nbad') content").write.parquet(
        f"{tmp_path}/out-waiting/batch_id=0/retry=0"
    )
    groups = tables.slices(spark, [f"{tmp_path}/out-waiting/batch_id=0/retry=0"])
    assert len(groups) == 3 and len({f for g in groups for f in g}) == 3
    spark.createDataFrame([], "doc_id STRING, stem STRING, target_lang STRING, content STRING, n_chunks INT, n_failed_chunks INT, out_name STRING").write.parquet(
        f"{tmp_path}/out/batch_id=0"
    )
    out, memory, asked = str(tmp_path / "out"), str(tmp_path / "memory"), Asked(tmp_path / "asked")
    options = {"max_attempts": 1, "max_chars": 3}
    assert retry_failed(spark, out, asked, memory, **options) == 6
    assert sorted(asked.texts()) == ["bad", "x0", "x1"]
    assert retry_failed(spark, out, asked, memory, **options) == 6
    assert asked.texts() == ["bad"]
    rows = translated_documents(spark, out).collect()
    assert sorted((r.doc_id, r.content, r.n_failed_chunks) for r in rows) == [(f"d{i}", f"x{i % 2}!\n\nbad", 1) for i in range(6)]
    assert spark.read.parquet(f"{out}-retried").groupBy("retry").count().filter(F.col("count") == 6).count() == 2


class Asked:
    """Notes every text, and refuses one."""

    def __init__(self, path):
        self.path = str(path)

    def __call__(self, texts, prompt):
        with open(self.path, "a") as log:
            log.writelines(f"{t}\n" for t in texts)
        return [ValueError("refused") if t == "bad" else f"{t}!" for t in texts]

    def texts(self):
        lines = open(self.path).read().split()
        open(self.path, "w").close()
        return lines


def test_run_again_after_its_retry(spark, tmp_path):
    """Whatever held a document last, it is there once."""
    (tmp_path / "md").mkdir()
    (tmp_path / "md/a.md").write_text("ugly")
    (tmp_path / "md/b.md").write_text("good")
    out, memory, calls = str(tmp_path / "out"), str(tmp_path / "memory"), Calls(tmp_path / "calls", bad="ugly")

    def once():
        query = translate_new_files(spark, f"file://{tmp_path}/md", out, str(tmp_path / "ck"), calls, memory=memory, max_attempts=1)
        assert query.awaitTermination(200)

    once()
    calls.bad = None
    assert retry_failed(spark, out, calls, memory, max_attempts=1) == 1
    for name in ("0", ".0.crc"):
        (tmp_path / f"ck/commits/{name}").unlink(missing_ok=True)
    once()
    rows = translated_documents(spark, out).collect()
    assert sorted((r.stem, r.content) for r in rows) == [("a", "T:ugly"), ("b", "T:good")]
