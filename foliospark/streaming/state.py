"""The stage state kept up to date by a stream over the event log.

The state of a document is an aggregate over its events, so Spark's own streaming aggregation keeps
it: one keyed state per document, held in the state store and changed by the events that arrive. The
latest event counts by its own time and run, not by when it came, so late and repeated events,
and a micro-batch that is run again, change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliospark import constants as K
from foliospark import schemas
from foliospark.operators import state as S

_ENTRY = "STRUCT<status: STRING, ts: TIMESTAMP, error: STRING, source_mtime: TIMESTAMP, run_id: STRING>"
_TRACKED = ", ".join(["doc_id STRING", *(f"{stage} {_ENTRY}" for stage in K.STAGES), "batch_id BIGINT"])


def track_stages(
    spark: SparkSession,
    events: str,
    out: str,
    checkpoint: str,
    target_lang: str | None = K.DEFAULT_TARGET_LANG,
    max_files_per_batch: int = 10_000,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query over the folder of an event log (an ``append=...`` folder for each append).

    Each micro-batch writes the documents whose state it changed to its own ``batch_id`` folder of ``out`` and
    overwrites that when it is run again.
    """
    log = (
        spark.readStream.schema(f"{schemas.STAGE_EVENTS}, append STRING")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(events)
        .drop("append")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    stream = S.latest_state(log, target_lang).writeStream.outputMode("update")
    stream = stream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        stream = stream.trigger(availableNow=True)
    return stream.start()


def tracked_state(spark: SparkSession, out: str) -> DataFrame:
    """The state that :func:`track_stages` has written, a row per document as ``latest_state`` gives."""
    rows = spark.read.schema(_TRACKED).parquet(out)
    last = F.max_by(F.struct(*K.STAGES), "batch_id").alias("s")
    return rows.groupBy("doc_id").agg(last).select("doc_id", *[f"s.{stage}" for stage in K.STAGES])
