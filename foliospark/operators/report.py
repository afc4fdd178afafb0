"""Outcome of a run per document and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.operators import state as S

SUCCESS = "success"


def outcome(translate: bool, success: Column | None = None) -> Column:
    """``success``, ``skipped`` or ``failed`` for a state row with the run's ``success`` flag.

    The completeness check looks at the stages of this run, the skip check at all stages.
    """
    success = F.col("success") if success is None else success
    stages = K.STAGES if translate else (K.STAGE_PARSE, K.STAGE_LAYOUT)
    complete = S.all_done(stages)
    return (
        F.when(success & complete & S.any_skipped(), K.SKIPPED)
        .when(success & complete, SUCCESS)
        .when(complete, K.SKIPPED)
        .otherwise(K.FAILED)
    )


def batch_totals(outcomes: DataFrame) -> DataFrame:
    """The one-row total; ``ok`` is the exit status of the run."""
    column = F.col("outcome")
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(column == SUCCESS).alias("success"),
        F.count_if(column == K.SKIPPED).alias("skipped"),
        F.count_if(column == K.FAILED).alias("failed"),
        (F.count_if(column == K.FAILED) == 0).alias("ok"),
    )


def batch_details(outcomes: DataFrame, *extra: str) -> DataFrame:
    """One record per document: ``file``, ``success``, ``error`` and its stages as JSON, then
    the ``extra`` columns of ``outcomes``.

    A table and not one nested value: gathering all documents into one cell would not survive
    a large run. Sort by ``path`` where the order matters.
    """
    stages = F.map_from_entries(
        F.transform(
            "stages",
            lambda s: F.struct(
                s["stage"],
                F.struct(s["status"].alias("status"), s["ts"].alias("timestamp"), s["error"].alias("error")),
            ),
        )
    )
    return outcomes.select("doc_id", "path", "file", "success", "error", "outcome", F.to_json(stages).alias("stages"), *extra)
