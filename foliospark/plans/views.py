"""The results of all runs as one table: for each document those of the run that holds them now.

Outputs lie by run, and the state says which run finished a document's stage last. A view joins the
two on document and run. A document whose last attempt at the stage failed has no current result (a
translation with failed chunks is one: those keep their original text), nor has one whose
stage was never reached; earlier results stay where their run has put them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark import schemas
from foliospark.operators import state as S
from foliospark.plans.batch import Tables
from foliospark.session import shared_path
from foliospark.sources.tables import small_broadcast


def pinned_runs(tables: Tables, stage: str, target_lang: str | None = None) -> DataFrame:
    """(doc_id, run_id, status): the run that each document's last attempt at ``stage`` belongs to."""
    recorded = S.latest_state(tables.events(tables.state_version()), target_lang)
    entry = F.col(S.check_stage(stage))
    return recorded.filter(entry.isNotNull()).select("doc_id", entry["run_id"].alias("run_id"), entry["status"].alias("status"))


def current(
    tables: Tables, table: str, schema: str, stage: str, statuses: tuple[str, ...], target_lang: str | None = None
) -> DataFrame:
    """The rows of an output table that are current, with ``run_id``.

    Eager: the pins, a key and a run each, are written to the shared folder. The runs that still
    hold something prune the partitions of the table before anything of it is read, and few
    documents are broadcast to what is left; many are shuffled, together with the output's rows.
    """
    spark, work = tables.spark, shared_path(tables.spark, "current")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        # The filter stands behind the read, so that Spark takes it for a reason to prune.
        return spark.read.schema(df.schema).parquet(f"{work}/{name}").filter(F.col("status").isin(*statuses))

    pins = written(pinned_runs(tables, stage, target_lang), "pins")
    runs = written(pins.select("run_id", "status").distinct(), "runs")
    rows = tables.read(table, f"{schema}, run_id STRING")
    if target_lang is not None:
        rows = rows.filter(F.col("target_lang") == target_lang)
    rows = rows.join(small_broadcast(runs).select("run_id"), "run_id", "left_semi")
    return rows.join(small_broadcast(pins).drop("status"), ["doc_id", "run_id"])


def current_elements(tables: Tables) -> DataFrame:
    """The layout elements of every document whose layout is done."""
    rows = current(tables, "elements", schemas.ELEMENTS, K.STAGE_LAYOUT, (K.DONE,))
    return rows.filter(F.col("elem_idx").isNotNull()).drop("mtime", "success", "error")


def current_summaries(tables: Tables) -> DataFrame:
    """A summary for every document whose layout is done, also for those without elements."""
    rows = current(tables, "layout_summary", schemas.SUMMARY, K.STAGE_LAYOUT, (K.DONE,))
    return rows.drop("mtime", "success", "error")


def current_translations(tables: Tables, target_lang: str = K.DEFAULT_TARGET_LANG) -> DataFrame:
    """Every translated document in one language; failed chunks are counted in ``n_failed_chunks``."""
    done = (K.DONE, K.FAILED)
    rows = current(tables, "translated_markdown", schemas.TRANSLATED, K.STAGE_TRANSLATE, done, target_lang)
    return rows.drop("mtime")
