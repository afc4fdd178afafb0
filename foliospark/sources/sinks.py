"""Writers. Each writes one table in parallel; none gathers it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import language_suffix
from foliospark.operators import calls


def write_summaries(summaries: DataFrame, path: str, format: str = "parquet") -> None:
    """Document summaries as a table (``parquet``) or for interchange (``json``)."""
    summaries.write.mode("overwrite").format(format).save(path)


def with_output_name(docs: DataFrame, stem: str = "stem", target_lang: str = "target_lang") -> DataFrame:
    """Add ``out_name``, the translated document's file name; documents of one stem share it."""
    name = F.concat(F.col(stem), F.lit("_"), language_suffix(F.col(target_lang)), F.lit(".md"))
    return docs.withColumn("out_name", name)


def write_translated(docs: DataFrame, path: str) -> None:
    docs.write.mode("append").partitionBy("target_lang").parquet(path)


def with_output_path(docs: DataFrame) -> DataFrame:
    """Add ``out_path``: language, a folder of the document's own, file name.

    The folder is the stem and the start of a digest of ``doc_id``, so documents of one stem stay
    apart; the language stands in front, because some share a file name suffix.
    """
    lang = F.regexp_replace("target_lang", "[/\\\\\\x00]", "_")
    own = F.concat_ws("-", "stem", F.substr(F.sha2(F.col("doc_id").cast("string"), 256), F.lit(1), F.lit(16)))
    return docs.withColumn("out_path", F.concat_ws("/", lang, own, "out_name"))


def export_markdown(docs: DataFrame, folder: str, bom: bool = True) -> None:
    """One file per document (``doc_id``, ``stem``, ``target_lang``, ``out_name``, ``content``).

    Written by the tasks below ``folder``, a place all executors share, at ``out_path``. A file
    appears under its name only when it is whole, and writing it again gives the same file, so a
    retried task does no harm.
    """
    rows = with_output_path(docs).select(F.col("out_path").alias("out_name"), "content")
    rows.foreachPartition(calls.write_files(folder, bom))


def write_results(results: DataFrame, path: str, index: str = "chunk_idx") -> None:
    """Translation results as JSON records."""
    results.select(
        *[c for c in ("doc_id",) if c in results.columns],
        F.col(index).alias("index"),
        "original",
        "translated",
        "success",
        "error",
    ).write.mode("overwrite").json(path)


def append_events(events: DataFrame, path: str) -> None:
    """Write one append of stage events to a folder of its own."""
    events.write.parquet(path)


def write_batch_summary(totals: DataFrame, path: str) -> None:
    """The one-row total as one JSON record."""
    totals.coalesce(1).write.mode("overwrite").json(path)
