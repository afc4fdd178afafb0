import random
import shutil
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark import schemas
from foliospark.operators import state as S
from foliospark.streaming.state import track_stages, tracked_state


def events(seed, n, docs=12):
    r, start = random.Random(seed), datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        stage, status = r.choice(K.STAGES), r.choice([*K.STATUSES, "odd"])
        ts = start + timedelta(minutes=r.randrange(300))
        lang = r.choice(["英文", "中文"]) if stage == "translate" else None
        rows.append((f"d{r.randrange(docs)}", stage, lang, status, ts, f"e{i}", ts if status == "done" else None, f"{seed}-{i:04}"))
    return rows


def rows_of(state):
    return sorted((r.asDict(recursive=True) for r in state.collect()), key=lambda r: r["doc_id"])


def test_late_repeated_and_replayed_events(spark, tmp_path):
    log, out, checkpoint = f"{tmp_path}/events", f"{tmp_path}/state", tmp_path / "checkpoint"

    def append(name, rows):
        df = spark.createDataFrame(rows, schemas.STAGE_EVENTS)
        df.repartition(2).write.parquet(f"{log}/append={name}")

    def once():
        query = track_stages(spark, log, out, str(checkpoint), max_files_per_batch=2)
        assert query.awaitTermination(300)
        want = S.latest_state(spark.read.schema(f"{schemas.STAGE_EVENTS}, append STRING").parquet(log), "英文")
        assert rows_of(tracked_state(spark, out)) == rows_of(want)

    first = events(1, 120)
    append("a", first)
    append("b", events(2, 60))
    once()
    late = [(*r[:4], r[4] - timedelta(days=1), *r[5:]) for r in events(3, 30)]
    append("c", late)
    append("d", first[:50])
    append("e", [("new", "parse", None, "done", datetime(2025, 1, 1), "", datetime(2025, 1, 1), "9")])
    once()
    # The last batch wrote its rows but was not committed: it is run again.
    commits = sorted((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    (checkpoint / f"commits/.{commits[-1].name}.crc").unlink(missing_ok=True)
    shutil.rmtree(f"{out}/batch_id={commits[-1].name}")
    once()


def test_one_document_with_a_third_of_the_events(spark, tmp_path):
    rows = events(4, 600) + [("hot", *r[1:]) for r in events(5, 300)]
    df = spark.createDataFrame(rows, schemas.STAGE_EVENTS).repartition(6)
    df.write.parquet(f"{tmp_path}/events/append=a")
    query = track_stages(spark, f"{tmp_path}/events", f"{tmp_path}/state", f"{tmp_path}/checkpoint", "中文")
    assert query.awaitTermination(300)
    state = tracked_state(spark, f"{tmp_path}/state")
    assert rows_of(state) == rows_of(S.latest_state(df, "中文"))
    assert state.filter(F.col("doc_id") == "hot").count() == 1
