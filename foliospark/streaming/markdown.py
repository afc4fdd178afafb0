"""Translating Markdown files as they arrive.

The streaming file source serves new files once and does not come back to a modified file;
changed inputs are the batch run's work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliospark import constants as K
from foliospark.functions import paths as P
from foliospark.functions.text import is_blank, without_bom
from foliospark.operators import calls
from foliospark.operators import chunks as C
from foliospark.operators import memory as M
from foliospark.operators.translate import translate_markdown
from foliospark.session import shared_path, shuffles_freed
from foliospark.sources.files import contents, list_files, listable, shown
from foliospark.sources.sinks import with_output_name
from foliospark.sources.tables import exists, mark, names_in, remove, slices, small_broadcast, write_texts


def translate_new_files(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    fn: Callable,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    max_files_per_batch: int = 10_000,
    available_now: bool = True,
    memory: str | None = None,
    take: bool = False,
    **options,
) -> StreamingQuery:
    """Start a query that translates each new Markdown file of ``folder`` once.

    Every micro-batch overwrites its own ``batch_id`` partition of ``out``, so a batch replayed
    after a failure leaves no duplicates.

    With ``memory``, the folder of a translation memory, each distinct text is sent once, and documents
    with failed chunks are taken along by the next micro-batch, which sends those chunks again: a
    document's last row counts (:func:`translated_documents`). What still waits is kept beside
    ``out``, by batch; :func:`retry_failed` sends it again without new files.

    With ``available_now`` the folder is listed by a task at the start, what is new is noted below ``checkpoint``, and the
    stream goes over those notes, ``max_files_per_batch`` files at a time, which its tasks open. Spark's own source lists
    each file of a batch once more, in a task of its own up to 10,000 of them, and keeps all files in the driver. It still
    serves streams that go on for good, checkpoints that began with it, path patterns and stores that only Spark knows. A
    checkpoint that began with notes goes on with them.

    With ``take`` the files are the stream's: each micro-batch writes its documents as one table below ``checkpoint``, a
    fraction of what small files take on disk, and then deletes the files. A batch that is run again goes by that table,
    which stays until the next one begins. Spark's own source deletes its files after the batch.
    """
    log = f"{checkpoint.rstrip('/')}/arrivals"
    ahead = exists(spark, log)
    if ahead and not available_now:
        raise ValueError(f"the files of this checkpoint are listed at each start, go on with available_now: {checkpoint}")
    if ahead or (available_now and not exists(spark, f"{checkpoint.rstrip('/')}/sources") and listable(folder)):
        _note_arrivals(spark, folder, log, max_files_per_batch)
        source = (
            spark.readStream.schema(_ARRIVALS)
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1)
            .option("maxFileAge", "36500d")
            .parquet(log)
        )
    else:
        source = (
            spark.readStream.format("text")
            .schema("value STRING")
            .option("cleanSource", "delete" if take else "off")
            .option("wholetext", "true")
            .option("pathGlobFilter", f"*{K.MARKDOWN_SUFFIX}")
            .option("maxFilesPerTrigger", max_files_per_batch)
            .load(folder)
            .select(
                P.plain_path(F.col("_metadata.file_path")).alias("path"), without_bom(F.col("value")).alias("content")
            )
        )

    def documents(batch: DataFrame) -> DataFrame:
        path = F.col("path")
        found = batch if "content" in batch.columns else contents(batch)
        return found.select(P.document_id(path).alias("doc_id"), P.stem(path).alias("stem"), "content")

    def taken(batch: DataFrame, batch_id: int) -> str:
        top = f"{checkpoint.rstrip('/')}/taken"
        for name in names_in(spark, top):
            if int(name) < batch_id:
                remove(spark, f"{top}/{name}")
        mine = f"{top}/{batch_id}"
        if not exists(spark, f"{mine}/whole"):
            write_texts(documents(batch), f"{mine}/docs", "overwrite")
            mark(spark, f"{mine}/whole")
        tasks = spark.sparkContext.defaultParallelism * 4
        batch.select("path").repartition(tasks).foreachPartition(calls.delete_files())
        return f"{mine}/docs"

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = taken(batch, batch_id) if take and "content" not in batch.columns else None
        if memory:
            work = shared_path(spark, "stream-batch")
            if not kept:
                write_texts(documents(batch), kept := f"{work}/docs")
            last, retry = _waiting(spark, out, batch_id)
            _translate_remembered(
                spark, [kept] if last is None else [kept, _waiting_at(out, last, retry)], fn, f"{out}/batch_id={batch_id}",
                _waiting_at(out, batch_id, 0), work, target_lang, memory, options,
            )
            return
        docs = spark.read.schema(_WAITING).parquet(kept) if kept else documents(batch)
        done = translate_markdown(docs, fn, target_lang, keys=("doc_id", "stem"), **options)
        with_output_name(done).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    stream = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        stream = stream.trigger(availableNow=True)
    return stream.start()


_ARRIVALS = "path STRING, mtime TIMESTAMP, length BIGINT"


def _note_arrivals(spark: SparkSession, folder: str, log: str, files_per_batch: int) -> None:
    """Append the Markdown files right in ``folder`` that the log does not have, oldest first, to it: one file of the
    log for each micro-batch. What a crash leaves out is appended by the next start."""
    listed = list_files(spark, folder, recursive=False).select("path", "mtime", "length")
    new = listed.filter(F.col("path").endswith(K.MARKDOWN_SUFFIX) & shown(folder))
    if exists(spark, log):
        known = spark.read.schema(_ARRIVALS).option("recursiveFileLookup", "true").parquet(log)
        new = new.join(known.select("path"), "path", "left_anti")
    work = shared_path(spark, "arrivals")
    placed = new.orderBy("mtime", "path").withColumn("at", F.monotonically_increasing_id())
    placed.write.parquet(f"{work}/placed")
    placed = spark.read.schema(placed.schema).parquet(f"{work}/placed").withColumn("part", F.shiftright("at", 33))
    # One row for each sorted partition.
    before, bases = 0, [(-1, 0)]
    for row in placed.groupBy("part").count().orderBy("part").collect():
        bases.append((row["part"], before))
        before += row["count"]
    starts = F.broadcast(spark.createDataFrame(bases, "part BIGINT, base BIGINT"))
    place = F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)
    batches = placed.join(starts, "part").withColumn("batch", F.floor(place / files_per_batch))
    batches = batches.select(*_names(_ARRIVALS), "batch").repartition("batch")
    batches.write.partitionBy("batch").parquet(f"{log}/{work.rsplit('/', 1)[-1]}")


_WAITING = "doc_id STRING, stem STRING, content STRING"
_DONE = (
    "doc_id STRING, stem STRING, target_lang STRING, content STRING, n_chunks INT, n_failed_chunks INT, "
    "out_name STRING, batch_id BIGINT"
)


def _waiting(spark: SparkSession, out: str, before: int) -> tuple[int | None, int]:
    """The last batch before that one, and its last retry: what has failed chunks still lies there."""
    path = f"{out}-waiting"
    if not exists(spark, path):
        return None, 0
    rows = spark.read.schema(f"{_WAITING}, batch_id BIGINT, retry BIGINT").parquet(path)
    last = rows.filter(F.col("batch_id") < before).agg(F.max(F.struct("batch_id", "retry"))).first()[0]
    return (None, 0) if last is None else (last.batch_id, last.retry)


def _waiting_at(out: str, batch_id: int, retry: int) -> str:
    return f"{out}-waiting/batch_id={batch_id}/retry={retry}"


def _translate_remembered(
    spark: SparkSession, docs: list[str], fn: Callable, out: str, waiting: str, work: str, target_lang: str, memory: str,
    options: dict,
) -> None:
    """Written documents by the memory to one folder, then those that have to be sent again to another: whoever dies
    in between sends again what the memory knows already.

    A slice of the documents after the other, each with what it leaves to the next deleted: work tables and shuffles are
    several times the texts. ``work`` is deleted at the end.
    """
    with shuffles_freed(spark):
        for i, files in enumerate(slices(spark, docs)):
            part, mode = f"{work}/{i}", "append" if i else "overwrite"
            # A batch without documents to send again has left an empty marker row.
            rows = spark.read.schema(_WAITING).parquet(*files).filter(F.col("doc_id").isNotNull())
            done, again = _translated_slice(rows, fn, work.rsplit("/", 1)[-1], part, target_lang, memory, dict(options))
            write_texts(done, out, mode)
            write_texts(again, f"{work}/again", mode)
            remove(spark, part)
        again = spark.read.schema(_WAITING).parquet(f"{work}/again")
        marker = spark.createDataFrame([(None, None, None)], _WAITING)
        write_texts(again.unionByName(marker), waiting, "overwrite")
    remove(spark, work)


def _translated_slice(
    docs: DataFrame, fn: Callable, run_id: str, work: str, target_lang: str, memory: str, options: dict
) -> tuple[DataFrame, DataFrame]:
    """The documents translated, and those of them with failed chunks as they came."""
    spark, keys = docs.sparkSession, ("doc_id", "stem")
    separator = options.pop("separator", K.PARAGRAPH_SEPARATOR)
    max_chars = options.pop("max_chars", K.MAX_CHARS)
    blank = is_blank(F.col("content"))
    chunks = C.chunk_rows(docs.filter(~blank), list(keys), separator=separator, max_chars=max_chars)
    results = M.translate_remembered(
        chunks, fn, M.TranslationMemory(spark, memory), run_id, f"{work}/keys", target_lang,
        keys=(*keys, "chunk_idx"), **options,
    )
    write_texts(results, f"{work}/results")
    remove(spark, f"{work}/keys")
    results = spark.read.schema(results.schema).parquet(f"{work}/results")
    whole = M.documents_of(results, keys, separator)
    same = docs.filter(blank).select(
        *keys, F.lit(target_lang).alias("target_lang"), "content", F.lit(0).alias("n_failed_chunks"), F.lit(0).alias("n_chunks")
    )
    done = with_output_name(whole.unionByName(same)).select(*_names(_DONE)[:-1])
    failed = results.filter(~F.col("success")).select("doc_id").distinct()
    failed.write.parquet(f"{work}/failed")
    failed = spark.read.schema(failed.schema).parquet(f"{work}/failed")
    return done, docs.join(small_broadcast(failed), "doc_id", "left_semi").select(*_names(_WAITING))


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def retry_failed(
    spark: SparkSession, out: str, fn: Callable, memory: str, target_lang: str = K.DEFAULT_TARGET_LANG, **options
) -> int:
    """Send the failed chunks that still wait again, while the stream stands; how many documents it was.

    Results go beside ``out`` as a retry of the last batch, and the stream goes on from there.
    """
    batch_id, retry = _waiting(spark, out, 1 << 62)
    if batch_id is None:
        return 0
    waiting = _waiting_at(out, batch_id, retry)
    n = spark.read.schema(_WAITING).parquet(waiting).filter(F.col("doc_id").isNotNull()).count()
    if n:
        _translate_remembered(
            spark, [waiting], fn, f"{out}-retried/batch_id={batch_id}/retry={retry + 1}",
            _waiting_at(out, batch_id, retry + 1), shared_path(spark, "stream-batch"), target_lang, memory, options,
        )
    return n


def translated_documents(spark: SparkSession, out: str) -> DataFrame:
    """Every document of a stream's output once, from the last batch or retry that held it.

    No batch takes up a document again of which all chunks have succeeded, so such rows of batches pass and only their
    ids are shuffled.
    """
    rows = spark.read.schema(_DONE).parquet(out)
    whole = F.col("n_failed_chunks") == 0
    rest = rows.filter(~whole).withColumn("retry", F.lit(0).cast("bigint"))
    if exists(spark, f"{out}-retried"):
        rest = rest.unionByName(spark.read.schema(f"{_DONE}, retry BIGINT").parquet(f"{out}-retried"))
    rest = rest.join(rows.filter(whole).select("doc_id"), "doc_id", "left_anti")
    fields = [c for c in rows.columns if c != "doc_id"]
    last = F.max_by(F.struct(*fields), F.struct("batch_id", "retry")).alias("d")
    return rows.filter(whole).unionByName(rest.groupBy("doc_id").agg(last).select("doc_id", "d.*"))
