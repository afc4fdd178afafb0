"""Incremental stage state.

The state is an append-only event table (:data:`foliospark.schemas.STAGE_EVENTS`); the current
state is the latest event per document and stage. It is kept as one row per document with an
array of its three stages, so that one shuffle of pre-aggregated events answers every question
below: they are all projections over that row.

The modification time is recorded per stage, and the translate stage is keyed by target language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions.text import is_blank

def check_stage(stage: str) -> str:
    if stage not in K.STAGES:
        raise ValueError(f"unknown stage {stage!r}, expected one of {K.STAGES}")
    return stage


def mark_stage(
    docs: DataFrame,
    stage: str,
    status: Column | str,
    run_id: str,
    error: Column | str = "",
    target_lang: str | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """Event rows to append: one per document of ``docs`` (``doc_id``, ``mtime``).

    The source's modification time is recorded for ``done`` only.
    """
    check_stage(stage)
    if isinstance(status, str) and status not in K.STATUSES:
        raise ValueError(f"unknown status {status!r}, expected one of {K.STATUSES}")
    status = F.lit(status) if isinstance(status, str) else status
    error = F.lit(error) if isinstance(error, str) else error
    ts = F.date_trunc("second", F.current_timestamp()) if ts is None else ts
    lang = target_lang if stage == K.STAGE_TRANSLATE else None
    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.lit(stage).alias("stage"),
        F.lit(lang).cast("string").alias("target_lang"),
        status.alias("status"),
        ts.cast("timestamp").alias("ts"),
        error.alias("error"),
        F.when(status == K.DONE, F.col("mtime").cast("timestamp")).alias("source_mtime"),
        F.lit(run_id).alias("run_id"),
    )


def latest_state(events: DataFrame, target_lang: str | None = None) -> DataFrame:
    """One row per document: a struct per stage, NULL for stages without events.

    ``max_by`` aggregates map-side, so a document with any share of the events leaves one row
    per task. Events of other target languages are filtered at the scan. An unknown status reads
    as pending, with a note in ``error``.
    """
    mine = (F.col("stage") != K.STAGE_TRANSLATE) | F.col("target_lang").eqNullSafe(F.lit(target_lang))
    latest = [
        F.expr(
            "max_by(struct(status, ts, error, run_id), struct(ts, run_id)) "
            f"FILTER (WHERE stage = '{stage}') AS {stage}"
        )
        for stage in K.STAGES
    ]
    finished = [
        F.expr(
            "max_by(source_mtime, struct(ts, run_id)) "
            f"FILTER (WHERE stage = '{stage}' AND source_mtime IS NOT NULL) AS {stage}_mtime"
        )
        for stage in K.STAGES
    ]
    wide = events.filter(mine).groupBy("doc_id").agg(*latest, *finished)
    known = "status IN ({})".format(", ".join(f"'{s}'" for s in K.STATUSES))
    return wide.select(
        "doc_id",
        *[
            F.expr(
                f"CASE WHEN {stage} IS NOT NULL THEN struct("
                f"IF({stage}.{known}, {stage}.status, '{K.PENDING}') AS status, {stage}.ts AS ts, "
                f"IF({stage}.{known} OR {stage}.status IS NULL, {stage}.error, "
                f"concat('unknown status: ', {stage}.status)) AS error, "
                f"{stage}_mtime AS source_mtime, {stage}.run_id AS run_id) END AS {stage}"
            )
            for stage in K.STAGES
        ],
    )


def compact_events(events: DataFrame) -> DataFrame:
    """The fewest events with the same state: one per document, stage and target language.

    Each keeps the time its source was last finished at, also where a later event failed.
    """
    order = F.struct("ts", "run_id")
    seen = F.col("source_mtime").isNotNull()
    return (
        events.groupBy("doc_id", "stage", "target_lang")
        .agg(
            F.max_by(F.struct("status", "ts", "error", "run_id"), order).alias("e"),
            F.max_by("source_mtime", F.when(seen, order)).alias("source_mtime"),
        )
        .select(
            "doc_id", "stage", "target_lang", "e.status", "e.ts", "e.error", "source_mtime", "e.run_id"
        )
    )


def state_for(manifest: DataFrame, recorded: DataFrame) -> DataFrame:
    """Every document of ``manifest`` with all three stages; what is not recorded is pending.

    One join on the document key. The stages are filled in as an array, not by a cross join.
    """
    stages = ", ".join(
        f"struct('{stage}' AS stage, coalesce({stage}.status, '{K.PENDING}') AS status, "
        f"{stage}.ts AS ts, coalesce({stage}.error, '') AS error, "
        f"coalesce({stage}.source_mtime, timestamp_seconds(0)) AS source_mtime, "
        f"{stage}.run_id AS run_id)"
        for stage in K.STAGES
    )
    joined = manifest.join(recorded, "doc_id", "left")
    return joined.select(*manifest.columns, F.expr(f"array({stages})").alias("stages"))


def stage_of(stage: str) -> Column:
    """The struct of one stage in a state row."""
    return F.col("stages")[K.STAGES.index(check_stage(stage))]


def stage_needed(stage: str) -> Column:
    """True unless the stage is done for the current version of the source."""
    return _needed(stage_of(stage))


def _needed(entry: Column) -> Column:
    return (entry["status"] != K.DONE) | (F.col("mtime") > entry["source_mtime"])


def all_done(stages: list[str] | tuple[str, ...] | None = None) -> Column:
    """True when every stage asked for is done or skipped; none or an empty list means all."""
    targets = [check_stage(s) for s in (stages or K.STAGES)]
    return F.forall(
        F.filter("stages", lambda s: s["stage"].isin(*targets)),
        lambda s: s["status"].isin(K.DONE, K.SKIPPED),
    )


def any_skipped() -> Column:
    return F.exists("stages", lambda s: s["status"] == K.SKIPPED)


def stage_rows(state: DataFrame) -> DataFrame:
    """The state as one row per document and stage, with ``needed``.

    There are always three stages; the outer form only keeps the optimizer from adding a filter
    that would compute them twice.
    """
    rows = state.select("doc_id", "mtime", F.explode_outer("stages").alias("s"))
    return rows.select("doc_id", "mtime", "s.*", _needed(F.col("s")).alias("needed"))


def without_fresh_done(manifest: DataFrame, recorded: DataFrame, stage: str) -> DataFrame:
    """Documents that still need ``stage``, as an anti join: the same rows as the filter
    :func:`stage_needed` on :func:`state_for`, for callers that want nothing but the manifest."""
    check_stage(stage)
    done = recorded.filter(F.col(f"{stage}.status") == K.DONE)
    seen = F.coalesce(f"{stage}.source_mtime", F.timestamp_seconds(F.lit(0)))
    fresh = done.select("doc_id", seen.alias("_seen"))
    m, f = manifest.alias("m"), fresh.alias("f")
    same = (F.col("m.doc_id") == F.col("f.doc_id")) & (F.col("m.mtime") <= F.col("f._seen"))
    return m.join(f, same, "left_anti")


def overview(state: DataFrame) -> DataFrame:
    """One nested record per document: source path, recorded time and a map of its stages."""
    entry = F.transform(
        "stages",
        lambda s: F.struct(
            s["stage"], F.struct(s["status"].alias("status"), s["ts"].alias("timestamp"), s["error"].alias("error"))
        ),
    )
    mtime = F.array_max(F.transform("stages", lambda s: s["source_mtime"]))
    path = [c for c in ("path",) if c in state.columns]
    return state.select(
        "doc_id", *path, mtime.alias("source_mtime"), F.map_from_entries(entry).alias("stages")
    )


def document_gate(content: Column) -> Column:
    """What the translate stage does with a document: no Markdown or a blank one is skipped."""
    return F.when(is_blank(content), K.SKIPPED).otherwise("run")
