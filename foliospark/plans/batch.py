"""The batch run: manifest, extraction, layout, translation, state and report.

One Spark job per stage over all documents that need it. Every stage writes its output under the
run's own ``run_id`` and appends its stage events only after that write has committed, so a run
that dies leaves nothing that a later one would take for finished: readers reach an output only
through the run id in the event. Failures are rows, never job failures.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark import schemas
from foliospark.operators import chunks as C
from foliospark.operators import elements as E
from foliospark.operators import extract as X
from foliospark.operators import memory as M
from foliospark.operators import report as R
from foliospark.operators import state as S
from foliospark.operators import translate as TR
from foliospark.sources import files, sinks
from foliospark.sources.tables import small_broadcast

_TASK_BYTES = 128 * 1024 * 1024
MISSING_OUTPUT = "output of the finished parse stage is missing"


@dataclass(frozen=True)
class Tables:
    """The tables of one output folder."""

    spark: SparkSession
    out: str

    def path(self, table: str, run_id: str | None = None) -> str:
        base = f"{self.out.rstrip('/')}/{table}"
        return f"{base}/run_id={run_id}" if run_id else base

    def _folder(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def read(self, table: str, schema: str) -> DataFrame:
        """A table of all runs; without rows where no run has written it yet."""
        path = self.path(table)
        filesystem, folder = self._folder(path)
        if not filesystem.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def state_version(self) -> str | None:
        """The last compacted state, if there is any."""
        return self.read("state_versions", "version STRING").agg(F.max("version")).first()[0]

    def _appends(self) -> list[str]:
        """The appends to the event log that have committed: a few names for each run, from one listing."""
        filesystem, pattern = self._folder(f"{self.path('stage_events')}/append=*/_SUCCESS")
        found = filesystem.globStatus(pattern) or []
        return sorted(f.getPath().getParent().getName().removeprefix("append=") for f in found)

    def _covered(self, version: str) -> set[str]:
        rows = self.spark.read.schema("append STRING").parquet(self.path(f"stage_state/{version}/covers"))
        return {r["append"] for r in rows.collect()}

    def _events_of(self, appends: list[str]) -> DataFrame:
        """The events of some appends; the folders of others are not opened."""
        if not appends:
            return self.spark.createDataFrame([], schemas.STAGE_EVENTS)
        paths = [f"{self.path('stage_events')}/append={a}" for a in appends]
        return self.spark.read.schema(schemas.STAGE_EVENTS).parquet(*paths)

    def events(self, version: str | None = None, only_run: str | None = None) -> DataFrame:
        """The stage events, from a compacted state on when its version is given.

        Events lie in a folder per append. A compacted state knows which appends it holds, so
        what a run adds after the compaction, whenever that run began, is never left out.
        ``only_run`` reads the appends of one run alone.
        """
        if only_run is not None:
            return self._events_of([a for a in self._appends() if a.startswith(only_run)])
        if version is None:
            return self._events_of(self._appends())
        old = self.spark.read.schema(schemas.STAGE_EVENTS).parquet(self.path(f"stage_state/{version}/events"))
        covered = self._covered(version)
        return old.unionByName(self._events_of([a for a in self._appends() if a not in covered]))

    def append_events(self, events: DataFrame, run_id: str) -> None:
        append = f"{run_id}-{uuid.uuid4().hex[:8]}"
        sinks.append_events(events, f"{self.path('stage_events')}/append={append}")

    def compact(self) -> str:
        """Write the current state as a new version; later runs start from it.

        Nothing is overwritten: a version counts once it is in ``state_versions``, which is
        written after the state itself has committed. Runs may go on meanwhile. What is listed as covered are
        the appends that are still there, so the list is bounded by what :meth:`vacuum` leaves.
        """
        version, before, appends = new_run_id(), self.state_version(), self._appends()
        if before:
            known = self._covered(before)
            old = self.spark.read.schema(schemas.STAGE_EVENTS).parquet(self.path(f"stage_state/{before}/events"))
            fresh = old.unionByName(self._events_of([a for a in appends if a not in known]))
        else:
            fresh = self._events_of(appends)
        S.compact_events(fresh).write.parquet(self.path(f"stage_state/{version}/events"))
        covers = self.spark.createDataFrame([(a,) for a in appends], "append STRING").coalesce(1)
        covers.write.parquet(self.path(f"stage_state/{version}/covers"))
        done = self.spark.createDataFrame([(version,)], "version STRING").coalesce(1)
        done.write.mode("append").parquet(self.path("state_versions"))
        return version

    def vacuum(self, before: datetime) -> int:
        """Delete appends and states that a later state holds; how many folders went.

        Goes by start times: only what began before ``before`` (UTC), and of the states all but the last. A run in
        progress reads its own appends and the state it began with, so ``before`` has to lie before the
        start of every run that still goes on.
        """
        last = self.state_version()
        if last is None:
            return 0
        limit = f"{before:%Y%m%dT%H%M%S%f}"
        gone = [f"stage_events/append={a}" for a in self._covered(last) if a < limit]
        filesystem, states = self._folder(self.path("stage_state"))
        names = [f.getPath().getName() for f in filesystem.listStatus(states)]
        gone += [f"stage_state/{v}" for v in names if v < min(last, limit)]
        deleted = [filesystem.delete(self._folder(self.path(x))[1], True) for x in gone]
        return sum(map(bool, deleted))

    def extracted(self) -> DataFrame:
        return self.read("extracted", f"{schemas.EXTRACTED}, run_id STRING")

    def translated_chunks(self) -> DataFrame:
        return self.read("translated_chunks", schemas.TRANSLATED_CHUNKS)

    def write(self, df: DataFrame, table: str, run_id: str) -> DataFrame:
        """Commit a stage's output and read it back, so that it is computed once."""
        path = self.path(table, run_id)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class BatchRun:
    """Handles on what a run wrote."""

    run_id: str
    tables: Tables
    details: DataFrame
    totals: DataFrame


def new_run_id() -> str:
    """Run ids sort by start time."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _tasks(spark: SparkSession, docs: DataFrame, size: str | None) -> int | None:
    """Tasks for a stage that opens files: enough for every core and for the bytes read.

    Given explicitly, because a list of keys is far too small for the shuffle to spread itself.
    """
    cores = spark.sparkContext.defaultParallelism
    if not size:
        return cores * 4
    total = docs.agg(F.sum(size)).first()[0] or 0
    return max(cores * 4, -(-int(total) // _TASK_BYTES))


def run_batch(
    spark: SparkSession,
    manifest: DataFrame,
    out: str,
    extractor: Callable | None,
    translator: Callable | None = None,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    content: str | None = None,
    separator: str = K.PARAGRAPH_SEPARATOR,
    max_chars: int = K.MAX_CHARS,
    parallelism: int | None = None,
    max_attempts: int = K.MAX_ATTEMPTS,
    wait_seconds: float = 1.0,
    backoff: float = 2.0,
    system_prompt: str | None = None,
    export_to: str | None = None,
    texts_per_call: int = K.TEXTS_PER_CALL,
    saved_events: DataFrame | None = None,
    memory: str | None = None,
    in_flight: int = 1,
    stop_after: int | None = None,
) -> BatchRun:
    """Bring every document of ``manifest`` (``doc_id, path, file, stem, mtime``) up to date.

    Only new, changed or unfinished stages run. ``content`` names a manifest column with the raw
    document; without it the extractor tasks open the files. A failed stage ends its document for
    this run, later stages keep their state. After a run with failed chunks only those chunks are
    sent again. Without an ``extractor`` the manifest's ``layout_path`` and ``markdown_path`` name
    what a parser has left; the files are opened by the tasks, for the documents that need it.
    ``saved_events`` are stage events from elsewhere that count before all others. ``export_to`` is a folder for the documents translated by this run, a file each.

    ``memory`` is the folder of a translation memory, which other output folders may share: with it
    every distinct text is sent once for a prompt and language, over all documents and runs; the texts that are
    unknown and the translations are shuffled for that. Without it every chunk is sent and none shuffled.
    How calls are made (``texts_per_call``, ``in_flight``, ``stop_after``) is said in ``operators.translate``.

    The recorded state is folded once and written; later questions add this run's own events to
    it. Keys alone decide what is parsed. Raw documents and texts go through no shuffle, but for
    documents whose failed chunks are sent again, and an explicit ``parallelism``.
    """
    run_id, tables = new_run_id(), Tables(spark, out)
    if saved_events is not None:
        tables.append_events(saved_events, f"{run_id}-saved")
    version = tables.state_version()
    wanted = ("length",) if extractor else ("length", "layout_path", "markdown_path")
    optional = [c for c in wanted if c in manifest.columns]
    columns = [F.col(c) for c in ("path", "file", "stem", "mtime", *optional)]
    listed = tables.write(
        manifest.select(F.col("doc_id").cast("string").alias("doc_id"), *columns), "manifest", run_id
    )

    recorded = tables.write(S.compact_events(tables.events(version)), "state_before", run_id)
    first_run = recorded.isEmpty()

    def current() -> DataFrame:
        events = recorded.unionByName(tables.events(only_run=f"{run_id}-run"))
        return S.state_for(listed, S.latest_state(events, target_lang))

    def mark(docs: DataFrame, stage: str, status, error="") -> None:
        events = S.mark_stage(docs, stage, status, run_id, error, target_lang)
        tables.append_events(events, f"{run_id}-run")

    def outcome_of(success):
        return F.when(success, K.DONE).otherwise(K.FAILED)

    # Parse. What this run parses is known to need the later stages before it is parsed, so
    # their flags travel with it and no text is ever joined to the state.
    flags = [
        S.stage_needed(K.STAGE_LAYOUT).alias("layout_needed"),
        S.stage_needed(K.STAGE_TRANSLATE).alias("translate_needed"),
    ]
    keys = ["path", "mtime", "stem", *optional]
    if content and first_run:
        docs = manifest.select(
            F.col("doc_id").cast("string").alias("doc_id"), "path", "mtime", "stem", content,
            *[F.lit(True).alias(f"{stage}_needed") for stage in (K.STAGE_LAYOUT, K.STAGE_TRANSLATE)],
        )
        tasks = parallelism
    else:
        docs = tables.write(
            current().filter(S.stage_needed(K.STAGE_PARSE)).select("doc_id", *keys, *flags), "to_parse", run_id
        )
        tasks = parallelism or _tasks(spark, docs, "length" if "length" in docs.columns else None)
        if content:
            raw = manifest.select(F.col("doc_id").cast("string").alias("doc_id"), content)
            docs, tasks = raw.join(small_broadcast(docs), "doc_id"), parallelism
    kept = ("mtime", "stem", "layout_needed", "translate_needed")
    if extractor:
        made = X.extract_elements(
            docs, extractor, content=content, keep=kept,
            parallelism=tasks, max_attempts=max_attempts, wait_seconds=wait_seconds,
        )
    else:
        made = X.opened_artifacts(docs, kept, tasks)
    extracted = tables.write(made, "extracted", run_id)
    mark(extracted, K.STAGE_PARSE, outcome_of(F.col("success")), F.col("error"))
    parsed_now = extracted.filter("success")

    # Layout.
    parsed = ~S.stage_needed(K.STAGE_PARSE)
    parsed_by = S.stage_of(K.STAGE_PARSE)["run_id"].alias("run_id")
    older = current().filter(parsed & (parsed_by != run_id) & S.stage_needed(K.STAGE_LAYOUT))
    older = tables.write(older.select("doc_id", "mtime", "stem", parsed_by), "to_layout", run_id)
    docs = parsed_now.filter("layout_needed").select("doc_id", "mtime", "layout_json", F.lit(True).alias("found"))
    if not older.isEmpty():
        docs = docs.unionByName(_outputs(tables, older, "layout_json").drop("stem"))
    checked = E.parse_layout(docs).withColumn(
        "error", F.when(~F.col("found"), MISSING_OUTPUT).otherwise(F.col("error"))
    )
    keys = ["doc_id", "mtime", "success", "error"]
    rows = tables.write(E.normalise(E.raw_elements(checked, keys, outer=True), keys), "elements", run_id)
    summary = tables.write(E.document_summary(rows, keys), "layout_summary", run_id)
    mark(summary, K.STAGE_LAYOUT, outcome_of(F.col("success")), F.col("error"))

    # Translate.
    laid_out = parsed & ~S.stage_needed(K.STAGE_LAYOUT)
    if translator is None:
        undone = laid_out & (S.stage_of(K.STAGE_TRANSLATE)["status"] != K.DONE)
        mark(current().filter(undone), K.STAGE_TRANSLATE, K.SKIPPED)
    else:
        entry = S.stage_of(K.STAGE_TRANSLATE)
        todo = current().filter(laid_out & S.stage_needed(K.STAGE_TRANSLATE)).select(
            "doc_id", "mtime", "stem", parsed_by,
            F.when(entry["status"] == K.FAILED, entry["run_id"]).alias("failed_run_id"),
        )
        todo = tables.write(todo, "to_translate", run_id)
        failed = tables.write(summary.filter(~F.col("success")).select("doc_id"), "failed_layouts", run_id)
        docs = parsed_now.filter("translate_needed").join(small_broadcast(failed), "doc_id", "left_anti")
        docs = docs.select("doc_id", "mtime", "stem", "markdown")
        older = todo.filter(F.col("run_id") != run_id)
        if memory:
            # What failed is not in the memory and what did not is, so retries need no path of their own.
            older = older.withColumn("failed_run_id", F.lit(None).cast("string"))
        retried = older.filter(F.col("failed_run_id").isNotNull())
        older = older.filter(F.col("failed_run_id").isNull()).drop("failed_run_id")
        if not older.isEmpty():
            docs = docs.unionByName(_outputs(tables, older, "markdown").drop("found"))
        options = dict(
            system_prompt=system_prompt, parallelism=parallelism, max_attempts=max_attempts,
            backoff=backoff, texts_per_call=texts_per_call, in_flight=in_flight, stop_after=stop_after,
        )
        keys = ("doc_id", "mtime", "stem")
        sendable = docs.filter(S.document_gate(F.col("markdown")) != K.SKIPPED)
        if memory:
            chunks = C.chunk_rows(
                sendable, list(keys), content="markdown", separator=separator, max_chars=max_chars
            )
            results = M.translate_remembered(
                chunks, translator, M.TranslationMemory(spark, memory), run_id, tables.path("chunk_keys", run_id),
                target_lang, keys=(*keys, "chunk_idx"), **options,
            )
            results = tables.write(results, "translated_chunks", run_id)
            whole = M.documents_of(results, keys, separator)
        else:
            results, whole = _sent(
                tables, run_id, sendable, retried, translator, target_lang, separator, max_chars, options
            )
            tables.write(results, "translated_chunks", run_id)
        whole = sinks.with_output_name(whole).select(
            "doc_id", "mtime", "stem", "target_lang", "out_name", "n_failed_chunks", "content"
        )
        whole = tables.write(whole, "translated_markdown", run_id)
        n = F.col("n_failed_chunks")
        note = F.when(n > 0, F.concat(n.cast("string"), F.lit(" chunks failed"))).otherwise("")
        mark(whole, K.STAGE_TRANSLATE, outcome_of(n == 0), note)
        # The gate let no chunk of these through.
        gated = todo.join(whole.select("doc_id"), "doc_id", "left_anti")
        mark(gated, K.STAGE_TRANSLATE, K.SKIPPED)
        if export_to:
            sinks.export_markdown(whole, export_to)

    # Report.
    mine = F.filter("stages", lambda s: s["run_id"] == run_id)
    failures = F.filter(mine, lambda s: s["status"] == K.FAILED)
    outcomes = (
        current()
        .withColumn("success", F.size(failures) == 0)
        .withColumn("error", F.coalesce(F.get(failures, F.lit(0))["error"], F.lit("")))
        .withColumn("outcome", R.outcome(translator is not None))
        .withColumn("stages_run", F.size(F.filter(mine, lambda s: s["status"] != K.SKIPPED)))
    )
    details = tables.write(R.batch_details(outcomes, "stages_run"), "batch_details", run_id)
    totals = R.batch_totals(details)
    sinks.write_batch_summary(totals, tables.path("batch_summary", run_id))
    return BatchRun(run_id, tables, details, totals)


def _sent(
    tables: Tables,
    run_id: str,
    docs: DataFrame,
    retried: DataFrame,
    translator: Callable,
    target_lang: str,
    separator: str,
    max_chars: int,
    options: dict,
) -> tuple[DataFrame, DataFrame]:
    """Chunk results and whole documents, every chunk sent; of ``retried`` ones those that failed."""
    keys = ("doc_id", "mtime", "stem")
    answered = TR.answer_documents(
        docs, translator, target_lang,
        keys=keys, content="markdown", separator=separator, max_chars=max_chars, **options,
    )
    answered = tables.write(answered, "answers", run_id)
    results = TR.result_rows(answered, keys, target_lang)
    whole = TR.joined_documents(answered, keys, target_lang, separator)
    if not retried.isEmpty():
        again = _outputs(tables, retried.drop("failed_run_id"), "markdown").drop("found")
        chunks = C.chunk_rows(
            again.filter(S.document_gate(F.col("markdown")) != K.SKIPPED), list(keys),
            content="markdown", separator=separator, max_chars=max_chars,
        ).withColumn("chunk_key", F.sha2("chunk", 256))
        more = _sent_again(tables, retried, chunks, translator, target_lang, options)
        more = tables.write(more, "retried_chunks", run_id)
        results = results.unionByName(more)
        whole = whole.unionByName(M.documents_of(more, keys, separator).drop("n_chunks"))
    return results, whole


def _outputs(tables: Tables, docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with one column of the extraction of the earlier run that parsed them.

    The run id is the partition column, so only runs that are still current get read, and few
    documents are broadcast instead of shuffling the texts to them. ``found`` is false where
    that output is gone.
    """
    output = tables.extracted().select("doc_id", "run_id", column)
    on = ["doc_id", "run_id"]
    found = output.join(small_broadcast(docs), on).withColumn("found", F.lit(True))
    lost = docs.join(output.select(*on), on, "left_anti").select(
        "*", F.lit(None).cast("string").alias(column), F.lit(False).alias("found")
    )
    return found.unionByName(lost).drop("run_id")


def _sent_again(
    tables: Tables,
    retried: DataFrame,
    chunks: DataFrame,
    translator: Callable,
    target_lang: str,
    options: dict,
) -> DataFrame:
    """Results for all ``chunks`` of partly failed documents; what succeeded then is taken over."""
    keys = ("doc_id", "mtime", "stem", "chunk_idx", "chunk_key")
    runs = retried.select("doc_id", F.col("failed_run_id").alias("run_id"))
    known = (
        tables.translated_chunks()
        .filter((F.col("target_lang") == target_lang) & F.col("success"))
        .join(runs, ["doc_id", "run_id"], "left_semi")
        .select("doc_id", "chunk_idx", "chunk_key", "translated")
    )
    on = ["doc_id", "chunk_idx", "chunk_key"]
    fresh = TR.translate_table(
        chunks.join(known, on, "left_anti"), translator, target_lang, keys=keys, **options
    )
    reused = chunks.join(known, on).select(
        *keys,
        F.lit(target_lang).alias("target_lang"),
        F.col("chunk").alias("original"),
        "translated",
        F.lit(True).alias("success"),
        F.lit("").alias("error"),
    )
    return fresh.unionByName(reused)


def run_files(
    spark: SparkSession,
    path: str,
    out: str,
    extractor: Callable | None,
    recursive: bool = False,
    artifacts: str | None = None,
    **options,
) -> BatchRun:
    """:func:`run_batch` over PDF files; a folder without any is an error.

    Without an extractor, ``artifacts`` is the output folder a parser has filled.
    """
    manifest = files.list_sources(spark, path, recursive)
    if manifest.isEmpty():
        raise ValueError(f"no PDF files under {path}")
    if extractor is None:
        listing = files.list_files(spark, artifacts, folders=True)
        manifest = files.resolve_artifacts(manifest, listing, artifacts)
    return run_batch(spark, manifest, out, extractor, **options)
