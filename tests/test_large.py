"""Documents in parts against the operators on whole documents and against plain versions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import carry, elements as E, large
from foliospark.operators import chunks as C


def greedy(lengths, limit):
    chunk, out, running = -1, [], None
    for n in lengths:
        if running is None or running + n > limit:
            chunk, running = chunk + 1, n
        else:
            running += n
        out.append(chunk)
    return out


def tables_of(lengths, limit, block):
    import pyarrow as pa

    made = large._block_table(limit, "key")
    for b in range(0, len(lengths), block):
        part = lengths[b : b + block]
        places = list(range(b, b + len(part)))
        yield made(
            pa.table({"key": ["k"] * len(part), "block": [b // block] * len(part), "place": places, "length": part})
        )["table"][0].as_py()


@pytest.mark.parametrize("seed", range(40))
def test_packing_tables_compose(seed):
    """What blocks hand on, alone and put together in any way, is what the plain fold has there."""
    r = random.Random(seed)
    limit = r.choice([1, 5, 20, 100])
    lengths = [r.choice([0, 0, 1, r.randrange(limit + 1), r.randrange(3 * limit)]) for _ in range(r.randrange(1, 400))]
    block = r.choice([1, 2, 7, 50])
    pack = large.Packing(limit, [limit + 1, 0])
    tables = list(tables_of(lengths, limit, block))
    chunks = greedy(lengths, limit)

    def state_after(n):
        last = max(i for i in range(n) if i == 0 or chunks[i] != chunks[i - 1])
        return [sum(lengths[last:n]), chunks[n - 1] + 1]

    state = pack.start
    for k, table in enumerate(tables):
        state = pack.apply(table, state)
        assert state == state_after(min(len(lengths), (k + 1) * block))
    whole = tables[0]
    for table in tables[1:]:
        whole = pack.compose(whole, table)
    assert pack.apply(whole, pack.start) == state
    if len(tables) > 2:
        back = tables[-1]
        for table in reversed(tables[1:-1]):
            back = pack.compose(table, back)
        for length in range(0, limit + 2):
            want = [length, 3]
            for table in tables[1:]:
                want = pack.apply(table, want)
            assert pack.apply(back, [length, 3]) == want


def test_one_document_of_a_third_of_all_rows(spark, monkeypatch):
    """Three levels of runs; the same chunks as from whole texts."""
    r = random.Random(3)
    docs = [(0, "\n".join("x" * r.choice([0, 0, 3, 40, 700, 4000]) + str(i) for i in range(6_000)))]
    docs += [(k, "\n".join("y" * r.randrange(900) for _ in range(r.randrange(1, 130)))) for k in range(1, 190)]
    docs += [(500, ""), (501, "\n" * 10_000), (502, "z" * 10_000)]
    frame = spark.createDataFrame(docs, "doc_id long, content string").repartition(8)
    want = {(x.doc_id, x.chunk_idx): x.chunk for x in C.chunk_rows(frame, ["doc_id"], separator="\n").collect()}
    monkeypatch.setattr(carry, "FAN", 2)
    monkeypatch.setattr(carry.handed_states, "__defaults__", (2,))
    rows = C.paragraphs(frame, ["doc_id"], separator="\n").repartition(16)
    got = {(x.doc_id, x.chunk_idx): x.chunk for x in large.chunk_paragraph_rows(rows, "doc_id", "\n").collect()}
    assert got == want


def test_no_paragraphs(spark):
    rows = spark.createDataFrame([], "doc_id long, para_idx int, paragraph string")
    assert large.chunk_paragraph_rows(rows, "doc_id").collect() == []
    rows = spark.createDataFrame([("a", 0, None), ("a", 1, "x")], "doc_id string, para_idx int, paragraph string")
    assert [tuple(x) for x in large.chunk_paragraph_rows(rows, "doc_id").collect()] == [("a", 0, "\n\nx")]


GOOD = [
    '[]', ' [ ] \n', '[{}]', '[{"text": "a"}, {"text": "b,]}[{\\"\\\\"}]', '﻿[{"text": "é\\u00e9 日本"}]',
    '[{"type": "table", "table_body": "<t>", "table_caption": ["x", {"y": [1, 2]}], "page_idx": 3, "bbox": [1, 2.5]}]',
    '[{"text": "' + 'long \\" ' * 300 + '", "page_idx": 1}, {"page_idx": "x"},{"text":null}\t]',
    json.dumps([{"text": f"t{i}", "page_idx": i} for i in range(150)], ensure_ascii=False),
]
BAD = [
    None, '', ' ', '{}', '[', ']', '[{}', '{}]', '[{},]', '[,{}]', '[{},,{}]', '[{}] x', 'x [{}]', '[{}][{}]', '[1]', '["a"]',
    '[{} {}]', '[{"a": 1]', '[{"a": 1}}', '[[{}]]', '"[{}]"', '[{"a": "x}]', '[null]', '[{}, null]', '[{"a" 1}]', '[{}] "', '[}',
    '[{}]]', '{"a": [{}]}', '[ , ]', '[{}]\\', '\\[{}]', '[{"a": [1}, 2]}]', 'null', '[{}]{}', '{[{}]}',
]


@pytest.mark.parametrize("size", [1, 3, 8, 64, 100_000])
def test_layout_in_parts(spark, size):
    rows = list(enumerate(GOOD + BAD))
    docs = spark.createDataFrame(rows, "doc_id long, layout_json string").repartition(4)
    parsed = E.parse_layout(docs)
    want = E.raw_elements(parsed, ["doc_id", "success", "error"], outer=True)
    want = want.withColumn("n_bad_fields", F.coalesce("n_bad_fields", F.lit(0)))
    parts = large.text_in_parts(docs, "doc_id", "layout_json", size)
    got = large.layout_elements_of_parts(parts, "doc_id")
    key = lambda r: (r.doc_id, -1 if r.elem_idx is None else r.elem_idx)
    columns = ["doc_id", "success", "error", "elem_idx", "type", "text", "table_caption", "page_idx", "bbox", "n_bad_fields"]
    a, b = (sorted(df.select(columns).collect(), key=key) for df in (want, got))
    assert a == b
    assert {r.doc_id for r in b if r.success} == set(range(len(GOOD)))


def test_lost_part_and_no_parts(spark):
    rows = [("a", 0, "[{}"), ("a", 1, None), ("a", 2, "]"), ("b", 0, "[{}"), ("b", 1, "]")]
    parts = spark.createDataFrame(rows, "k string, number int, piece string")
    got = {r.k: (r.success, r.elem_idx) for r in large.layout_elements_of_parts(parts, "k").collect()}
    assert got == {"a": (False, None), "b": (True, 0)}
    assert large.layout_elements_of_parts(parts.limit(0), "k").collect() == []


def test_structure_from_any_mode():
    """Parts read from the mode that the plain reading has there give the same brackets."""
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice('"\\[]{},ab') for _ in range(r.randrange(60)))
        cut = sorted(r.randrange(len(text) + 1) for _ in range(r.randrange(4)))
        marks, end = large.structure(text, large.OUTSIDE)
        found, mode = [], large.OUTSIDE
        for a, b in zip([0, *cut], [*cut, len(text)]):
            some, mode = large.structure(text[a:b], mode)
            found += [(a + p, c) for p, c in some]
        assert (found, mode) == (marks, end)
        inside, want = False, []
        skip = False
        for p, c in enumerate(text):
            if skip:
                skip = False
            elif inside and c == "\\":
                skip = True
            elif c == '"':
                inside = not inside
            elif not inside and c in "[]{},":
                want.append((p, c))
        assert marks == want


def test_parts_of_files(spark, tmp_path):
    """Characters of one to four bytes at every border; files that are empty, gone or not UTF-8."""
    from foliospark.sources import files

    text = "aé日🎉" * 40 + "x"
    (tmp_path / "a.json").write_bytes(text.encode())
    (tmp_path / "b.json").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (tmp_path / "empty.json").write_bytes(b"")
    (tmp_path / "broken.json").write_bytes(b"ok" * 50 + b"\xff" + b"ok" * 50)
    listing = files.list_files(spark, f"file://{tmp_path}")
    name = F.substring_index("path", "/", -1)
    gone = listing.limit(1).withColumn("path", F.lit(f"{tmp_path}/gone.json")).withColumn("length", F.lit(9).cast("long"))
    listing = listing.unionByName(gone).withColumn("name", name)
    for size in (4, 5, 7, 64, 10_000):
        rows = files.read_parts(listing, "name", size).orderBy("name", "number").collect()
        got = {}
        for r in rows:
            got.setdefault(r.name, []).append(r.piece)
        assert "".join(got["a.json"]) == "".join(got["b.json"]) == text
        assert got["empty.json"] == [""] and got["gone.json"] == [None] * len(got["gone.json"])
        assert got["broken.json"].count(None) == 1


def test_small_parts_share_tasks(spark, tmp_path):
    """The tasks that read parts follow the bytes and not the number of parts; a lost part is told by one reading."""
    from foliospark.sources import files

    (tmp_path / "a.json").write_text("[" + ", ".join('{"a": 1}' for _ in range(2000)) + "]")
    listing = files.list_files(spark, f"file://{tmp_path}")
    parts = files.read_parts(listing, "path", 3)
    assert parts.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert parts.count() == -(-(tmp_path / "a.json").stat().st_size // 3)


def test_runs_of_parts_pass_in_batches(spark, tmp_path):
    """Tasks get the sorted runs of many documents in one call, not a group for each."""
    import pyarrow as pa

    rows = [(k, n, [n + 1]) for k in range(50) for n in range(5)]
    parts = spark.createDataFrame(rows, "k int, number bigint, table array<bigint>").repartition(3)

    class Sum:
        start = [0]

        def apply(self, table, state):
            return [state[0] + table[0]]

        compose = apply

    table = pa.table({"k": [1, 1, 2], "parent": [0, 0, 0], "number": [0, 1, 0], "table": [[1], [2], [3]], "handed": [[0]] * 3})
    assert [b["state"].to_pylist() for b in carry._run_down(Sum(), "k")(iter(table.to_batches()))] == [[[0], [1], [0]]]
    for fan in (2, 3, 1024):
        states = carry.handed_states(parts, "k", Sum(), str(tmp_path / f"fan-{fan}"), fan)
        got = {(r.k, r.number): r.state for r in states.collect()}
        assert got == {(k, n): [n * (n + 1) // 2] for k in range(50) for n in range(5)}
