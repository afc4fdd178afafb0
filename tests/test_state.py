from datetime import datetime

import pytest
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark import schemas
from foliospark.operators import report as R
from foliospark.operators import state as S

T0, T1, T2 = (datetime(2024, 1, d) for d in (1, 2, 3))
LANG = K.DEFAULT_TARGET_LANG


def event(doc, stage, status, ts=T0, error="", mtime=T1, run="r1", lang=LANG):
    return (doc, stage, lang if stage == "translate" else None, status, ts, error,
            mtime if status == "done" else None, run)


def state(spark, events, docs=(("d", T1),), lang=LANG):
    log = spark.createDataFrame(events, schemas.STAGE_EVENTS)
    manifest = spark.createDataFrame(list(docs), "doc_id string, mtime timestamp")
    return S.state_for(manifest, S.latest_state(log, lang))


def needed(df, stage="parse"):
    return df.select(S.stage_needed(stage)).first()[0]


def test_initial_state(spark):
    row = S.overview(state(spark, [])).first()
    assert row.source_mtime == datetime(1970, 1, 1)
    assert {k: (v.status, v.timestamp, v.error) for k, v in row.stages.items()} == {
        s: ("pending", None, "") for s in K.STAGES
    }
    assert all(needed(state(spark, []), s) for s in K.STAGES)


@pytest.mark.parametrize(
    "status, mtime, expected",
    [("done", T1, False), ("done", T0, True), ("done", T2, False), ("failed", T1, True),
     ("skipped", T1, True), ("pending", T1, True)],
)
def test_needed(spark, status, mtime, expected):
    assert needed(state(spark, [event("d", "parse", status, mtime=mtime)])) is expected


def test_last_event_wins_whatever_the_order(spark):
    log = [event("d", "parse", "done", T2), event("d", "parse", "failed", T1, "broken"),
           event("d", "parse", "pending", T0)]
    assert needed(state(spark, log)) is False
    row = S.overview(state(spark, [log[1], log[2]])).first().stages["parse"]
    assert (row.status, row.error) == ("failed", "broken")
    tie = [event("d", "parse", "done", run="r1"), event("d", "parse", "failed", run="r2")]
    assert needed(state(spark, tie)) is True


def test_recorded_time_is_kept_when_a_later_run_fails(spark):
    log = [event("d", "parse", "done", T0, mtime=T1), event("d", "parse", "failed", T1)]
    assert S.overview(state(spark, log)).first().source_mtime == T1


def test_each_stage_has_its_own_time(spark):
    log = [event("d", "parse", "done", T2, mtime=T2), event("d", "layout", "done", T0, mtime=T1)]
    df = state(spark, log, docs=[("d", T2)])
    assert needed(df, "parse") is False and needed(df, "layout") is True


def test_translation_is_per_language(spark):
    log = [event("d", "translate", "done", lang="英文")]
    assert needed(state(spark, log, lang="英文"), "translate") is False
    assert needed(state(spark, log, lang="中文"), "translate") is True


def test_unknown_status_reads_as_pending(spark):
    row = S.overview(state(spark, [event("d", "parse", "exploded")])).first().stages["parse"]
    assert row.status == "pending" and "exploded" in row.error


@pytest.mark.parametrize(
    "statuses, stages, expected",
    [
        (("done", "done", "done"), None, True),
        (("done", "done", "skipped"), None, True),
        (("done", "done", "skipped"), [], True),
        (("done", None, None), None, False),
        (("done", None, None), ["parse"], True),
        (("done", "done", "failed"), ["parse", "layout"], True),
        (("done", "done", "failed"), None, False),
    ],
)
def test_all_done(spark, statuses, stages, expected):
    log = [event("d", s, v) for s, v in zip(K.STAGES, statuses) if v]
    assert state(spark, log).select(S.all_done(stages)).first()[0] is expected


def test_invalid_names(spark):
    docs = spark.createDataFrame([("d", T1)], "doc_id string, mtime timestamp")
    for call in (
        lambda: S.stage_needed("unknown"),
        lambda: S.all_done(["unknown"]),
        lambda: S.mark_stage(docs, "unknown", "done", "r"),
        lambda: S.mark_stage(docs, "parse", "finished", "r"),
        lambda: S.without_fresh_done(docs, docs, "unknown"),
    ):
        with pytest.raises(ValueError):
            call()


def test_marks_round_trip(spark):
    docs = spark.createDataFrame([("d", T1), ("e", T1)], "doc_id string, mtime timestamp")
    status = F.when(F.col("doc_id") == "d", "done").otherwise("failed")
    marks = S.mark_stage(docs, "translate", status, "r9", F.lit("why"), target_lang=LANG)
    assert [f.name for f in marks.schema] == [c.split()[0] for c in schemas.STAGE_EVENTS.split(", ")]
    rows = {r.doc_id: r for r in marks.collect()}
    assert rows["d"].source_mtime == T1 and rows["e"].source_mtime is None
    assert rows["d"].ts.microsecond == 0 and rows["d"].target_lang == LANG


def test_anti_join_equals_filter(spark):
    log = [event("a", "layout", "done", mtime=T1), event("b", "layout", "done", mtime=T0),
           event("c", "layout", "skipped")]
    docs = [(d, T1) for d in "abcd"]
    by_filter = state(spark, log, docs).filter(S.stage_needed("layout"))
    manifest = spark.createDataFrame(docs, "doc_id string, mtime timestamp")
    recorded = S.latest_state(spark.createDataFrame(log, schemas.STAGE_EVENTS), LANG)
    by_join = S.without_fresh_done(manifest, recorded, "layout")
    assert sorted(r.doc_id for r in by_join.collect()) == sorted(r.doc_id for r in by_filter.collect()) == ["b", "c", "d"]


@pytest.mark.parametrize(
    "statuses, success, translate, expected",
    [
        (("done", "done", "done"), True, True, "success"),
        (("done", "done", "skipped"), True, True, "skipped"),
        (("done", "done", "skipped"), True, False, "skipped"),
        (("done", "done", "pending"), True, False, "success"),
        (("done", "done", "pending"), True, True, "failed"),
        (("done", "done", "done"), False, True, "skipped"),
        (("failed", "pending", "pending"), False, True, "failed"),
    ],
)
def test_outcome(spark, statuses, success, translate, expected):
    df = state(spark, [event("d", s, v) for s, v in zip(K.STAGES, statuses)])
    assert df.select(R.outcome(translate, F.lit(success))).first()[0] == expected


def test_compaction_keeps_the_state(spark):
    log = [event("a", "parse", "done", T0, mtime=T1), event("a", "parse", "failed", T1, "why"),
           event("a", "layout", "done", T0), event("a", "layout", "skipped", T0, run="r0"),
           event("a", "translate", "done", lang="英文"), event("a", "translate", "failed", lang="中文"),
           event("b", "parse", "pending")]
    events = spark.createDataFrame(log, schemas.STAGE_EVENTS)
    small = S.compact_events(events)
    assert small.columns == events.columns and small.count() == 5
    for lang in ("英文", "中文", "other"):
        before, after = S.latest_state(events, lang), S.latest_state(small, lang)
        assert sorted(before.collect(), key=str) == sorted(after.collect(), key=str)
    assert sorted(S.compact_events(small).collect(), key=str) == sorted(small.collect(), key=str)


def test_totals(spark):
    outcomes = spark.createDataFrame([(o,) for o in ("success", "skipped", "skipped", "failed")], "outcome string")
    assert R.batch_totals(outcomes).first().asDict() == {
        "total": 4, "success": 1, "skipped": 2, "failed": 1, "ok": False
    }
    assert R.batch_totals(outcomes.filter("outcome <> 'failed'")).first().ok is True
    assert R.batch_totals(outcomes.limit(0)).first().ok is True


def test_state_is_one_shuffle_of_partial_aggregates(spark):
    log = spark.createDataFrame([event("d", "parse", "done")], schemas.STAGE_EVENTS)
    plan = S.latest_state(log, LANG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
