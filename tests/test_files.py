import json
import os

import pytest
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions import paths as P
from foliospark.operators import elements as E
from foliospark.sources import files, sinks


def touch(path, text=b"%PDF"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))
    return path


@pytest.fixture
def folder(tmp_path):
    for name in ("b.pdf", "a #1.PDF", "notes.txt", "sub/b.pdf", "k=v/c.pdf", "sub/deep/d+e.Pdf"):
        touch(tmp_path / name)
    return tmp_path


def written(folder):
    return "".join(p.read_text() for p in folder.glob("*.json"))


def names(df, root):
    return [os.path.relpath(r.path, root) for r in df.collect()]


def test_listing(spark, folder):
    top = files.in_path_order(files.list_sources(spark, str(folder)))
    assert names(top, folder) == ["a #1.PDF", "b.pdf"]
    everything = files.in_path_order(files.list_sources(spark, str(folder), recursive=True))
    assert names(everything, folder) == sorted(
        ["a #1.PDF", "b.pdf", "k=v/c.pdf", "sub/b.pdf", "sub/deep/d+e.Pdf"], key=lambda p: p.split("/")
    )
    rows = everything.collect()
    assert len({r.doc_id for r in rows}) == 5
    assert sorted(r.stem for r in rows) == ["a #1", "b", "b", "c", "d+e"]
    assert all(r.length == 4 and r.mtime for r in rows)


def test_single_file(spark, folder):
    assert names(files.list_sources(spark, str(folder / "a #1.PDF")), folder) == ["a #1.PDF"]


def test_empty_folder_and_bad_input(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert files.list_sources(spark, str(tmp_path / "empty")).count() == 0
    touch(tmp_path / "x.txt")
    for bad in ("x.txt", "missing", "missing.pdf"):
        with pytest.raises(ValueError):
            files.list_sources(spark, str(tmp_path / bad))


def test_empty_and_hidden_files_are_listed(spark, tmp_path):
    for name in ("empty.pdf", ".hidden.pdf", "_x/100% ü+ö.pdf"):
        touch(tmp_path / name, b"")
    found = files.list_sources(spark, f"file://{tmp_path}", recursive=True)
    assert sorted(names(found, tmp_path)) == [".hidden.pdf", "_x/100% ü+ö.pdf", "empty.pdf"]


def test_listed_and_read_paths_agree(spark, tmp_path):
    for name in ("a b.md", "x#1+2%20.md", "ü=é&?.md", "sub/plain.md"):
        touch(tmp_path / name, "text")
    listed = files.list_files(spark, str(tmp_path))
    assert listed.join(files.read_markdown(spark, str(tmp_path)), "path").count() == 4
    when = os.stat(tmp_path / "a b.md").st_mtime_ns // 1000
    assert listed.filter(F.col("path").endswith("a b.md")).select(F.unix_micros("mtime")).first()[0] == when


def test_stems_and_output_folders(spark):
    paths = ["/a/report.pdf", "/a/v1.2.pdf", "/a/.pdf", "/a/noext", "x.pdf", "/a/odd."]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(
        P.stem(F.col("p")).alias("s"), P.output_dir(F.col("p"), "/out/report/").alias("o")
    ).collect()
    assert [r.s for r in rows] == ["report", "v1.2", ".pdf", "noext", "x", "odd."]
    assert rows[0].o == "/out/report" and rows[1].o == "/out/report/v1.2"


def test_folders_are_ordered_part_by_part(spark):
    df = spark.createDataFrame([("/r/a b/x",), ("/r/a/x",)], "path string")
    assert [r.path for r in files.in_path_order(df).collect()] == ["/r/a/x", "/r/a b/x"]


def resolve(spark, root, *stems):
    manifest = spark.createDataFrame([(s,) for s in stems], "stem string")
    found = files.resolve_artifacts(manifest, files.list_files(spark, str(root)), str(root))
    return {
        r.stem: tuple(None if p is None else os.path.relpath(p, root) for p in (r.artifact_dir, r.layout_path, r.markdown_path))
        for r in found.collect()
    }


def test_artifacts(spark, tmp_path):
    for name in (
        "one/auto/one_content_list.json", "one/auto/a_content_list.json", "one/auto/one.md", "one/auto/a.md",
        "one/zzz/auto/other.md",
        "two/pipeline/auto/pipeline_content_list.json", "two/pipeline/auto/two.md", "two/two.md",
        "three/x_content_list.json", "three/three_zh.md", "three/z.md",
        "four/auto/images/1.png", "four/four.md",
        "five/b c/auto/l_content_list.json", "five/b/auto/m_content_list.json", "five/b/auto/five_en.md",
    ):
        touch(tmp_path / name)
    assert resolve(spark, tmp_path, "one", "two", "three", "four", "five", "six") == {
        "one": ("one/auto", "one/auto/one_content_list.json", "one/auto/one.md"),
        "two": ("two/pipeline/auto", "two/pipeline/auto/pipeline_content_list.json", "two/pipeline/auto/two.md"),
        "three": ("three", "three/x_content_list.json", "three/z.md"),
        "four": ("four/auto", None, None),
        "five": ("five/b/auto", "five/b/auto/m_content_list.json", None),
        "six": (None, None, None),
    }


def test_empty_artifact_folders(spark, tmp_path):
    for name in ("one/auto", "two/x/auto", "three"):
        (tmp_path / name).mkdir(parents=True)
    touch(tmp_path / "one/one.md")
    manifest = spark.createDataFrame([("one",), ("two",), ("three",), ("four",)], "stem string")
    listing = files.list_files(spark, str(tmp_path), folders=True)
    rows = files.resolve_artifacts(manifest, listing, str(tmp_path)).collect()
    assert {r.stem: r.artifact_dir and os.path.relpath(r.artifact_dir, tmp_path) for r in rows} == {
        "one": "one/auto", "two": "two/x/auto", "three": "three", "four": None
    }
    assert all(r.markdown_path is None for r in rows)


def test_deep_trees_are_listed_by_many_tasks(spark, tmp_path):
    for i in range(40):
        touch(tmp_path / f"top/a{i}/b/c.pdf")
    listed = files.list_files(spark, str(tmp_path))
    assert listed.count() == 40
    files_of = listed.select(F.input_file_name().alias("f")).distinct().count()
    assert files_of > 1


def test_layout_and_markdown_files(spark, tmp_path):
    touch(tmp_path / "d/auto/d_content_list.json", "﻿" + json.dumps([{"type": "text", "text": "é\n\n1"}], indent=1))
    touch(tmp_path / "e x/auto/e_content_list.json", "[")
    touch(tmp_path / "d/auto/d.md", "﻿# T\n\nbody\n")
    touch(tmp_path / "d/auto/empty.md", "")
    parsed = E.parse_layout(files.read_layout(spark, str(tmp_path)))
    assert {os.path.basename(r.path): r.success for r in parsed.collect()} == {
        "d_content_list.json": True, "e_content_list.json": False
    }
    assert E.raw_elements(parsed, ["path"]).first().text == "é\n\n1"
    assert [r.content for r in files.read_markdown(spark, str(tmp_path)).collect()] == ["# T\n\nbody\n"]
    listed = files.list_files(spark, str(tmp_path)).filter(F.col("path").endswith(".md"))
    joined = listed.join(files.read_markdown(spark, str(tmp_path)), "path", "left").collect()
    assert {os.path.basename(r.path): r.content for r in joined} == {"d.md": "# T\n\nbody\n", "empty.md": None}


def test_artifact_texts(spark, tmp_path):
    for name in ("in/a.pdf", "in/b.pdf", "in/c.pdf"):
        touch(tmp_path / name)
    touch(tmp_path / "out/a/auto/a_content_list.json", '[{"type": "title"}]')
    touch(tmp_path / "out/a/auto/a.md", "# A")
    touch(tmp_path / "out/b/x_content_list.json", "[]")
    touch(tmp_path / "out/b/b.md", "")
    manifest = files.list_sources(spark, str(tmp_path / "in"))
    found = files.read_artifacts(spark, manifest, f"file://{tmp_path}/out")
    assert {r.stem: (r.layout_json, r.markdown) for r in found.collect()} == {
        "a": ('[{"type": "title"}]', "# A"), "b": ("[]", ""), "c": (None, None)
    }
    assert {r.stem: r.success for r in E.parse_layout(found).collect()} == {"a": True, "b": True, "c": False}


def test_saved_state(spark, tmp_path):
    pdf = touch(tmp_path / "in/a b.pdf")
    touch(tmp_path / "in/c.pdf")
    saved = {
        "source_path": str(pdf), "source_mtime": 1715587200.25,
        "stages": {
            "first": {"status": "done", "timestamp": "2026-05-13T10:00:00", "error": ""},
            "layout": {"status": "failed", "timestamp": "2026-05-13T10:01:00", "error": "why"},
            "translate": {},
        },
    }
    touch(tmp_path / "out/a b/state.json", "﻿" + json.dumps(saved))
    touch(tmp_path / "out/c/state.json", "{broken")
    manifest = files.list_sources(spark, str(tmp_path / "in"))
    events = files.read_saved_state(spark, manifest, str(tmp_path / "out"), stage_names={"first": "parse"})
    rows = {r.stage: r for r in events.collect()}
    assert set(rows) == set(K.STAGES)
    assert rows["parse"].status == "done" and rows["parse"].source_mtime.timestamp() == 1715587200.25
    assert rows["parse"].ts.isoformat() == "2026-05-13T10:00:00"
    assert (rows["layout"].status, rows["layout"].error, rows["layout"].source_mtime) == ("failed", "why", None)
    assert (rows["translate"].status, rows["translate"].target_lang) == ("pending", K.DEFAULT_TARGET_LANG)


def test_exports(spark, tmp_path):
    docs = spark.createDataFrame(
        [
            (1, "d", "英文", "# Hé"), (2, "d", "英文", "same stem"),
            (3, "e", "other", "x"), (3, "e", "an/other", "no suffix of its own"),
        ],
        "doc_id int, stem string, target_lang string, content string",
    )
    named = sinks.with_output_name(docs)
    for _ in range(2):  # written again, as by a retried task
        sinks.export_markdown(named, f"file://{tmp_path}/md")
    found = {p.relative_to(tmp_path / "md"): p.read_bytes() for p in (tmp_path / "md").rglob("*.md")}
    assert sorted(p.name for p in found) == ["d_en.md", "d_en.md", "e_translated.md", "e_translated.md"]
    assert sorted({p.parts[0] for p in found}) == ["an_other", "other", "英文"]
    assert "\ufeff# Hé".encode() in found.values()
    sinks.write_translated(named, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).filter("target_lang = '英文'").count() == 2
    results = spark.createDataFrame(
        [("d", 1, "o", "t", True, "")],
        "doc_id string, chunk_idx int, original string, translated string, success boolean, error string",
    )
    sinks.write_results(results, str(tmp_path / "r"))
    line = written(tmp_path / "r")
    assert json.loads(line) == {"doc_id": "d", "index": 1, "original": "o", "translated": "t", "success": True, "error": ""}
    sinks.write_summaries(E.document_summary(
        spark.createDataFrame([("d", 0, "text", 0)], "doc_id string, elem_idx int, element_type string, page_idx int"), ["doc_id"]
    ), str(tmp_path / "s"), "json")
    assert json.loads(written(tmp_path / "s"))["type_distribution"] == {"text": 1}


def test_many_small_files_share_tasks(spark, tmp_path):
    """Not a task for every 32 files; rows as Spark's own reader gives them, also for patterns and several folders."""
    for i in range(200):
        touch(tmp_path / f"d{i % 3}/f{i}.md", f"text {i}")
    for name in (".h/a.md", "_h/a.md", "d0/.b.md", "d1/_b.md", "d0/empty.md", "d0/x.txt"):
        touch(tmp_path / name, "" if "empty" in name else "no")
    touch(tmp_path / "d2/_a=1.md", "shown")
    (tmp_path / "d2/latin.md").write_bytes(b"caf\xe9")
    got = files.read_markdown(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() <= 2
    plain = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").text(str(tmp_path), wholetext=True)
    both = [
        df.select(F.substring_index("path", "/", -1), F.hex("content")).collect()
        for df in (got, plain.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))
    ]
    assert sorted(both[0]) == sorted(both[1]) and len(both[0]) == 202
    assert files.read_markdown(spark, f"{tmp_path}/d*").count() == 202
    assert files.read_markdown(spark, [f"{tmp_path}/d0/", f"{tmp_path}/d1/f1.md", f"{tmp_path}/d0"]).count() == 68
