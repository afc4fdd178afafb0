"""Applying a user's translation function to chunks, documents and batches.

The function is ``fn(texts, system_prompt) -> list of str``. It may run again when a task is
retried or a result is used twice, so write results once and read them back wherever the calls
cost money; :func:`translate_distinct` and the batch run in ``plans`` do.

``texts_per_call`` bounds what one call is given, ``in_flight`` is the number of calls that one task
makes at the same time (the function then has to bear threads); results keep their order. Every text
is sent, whatever became of those before it. Whoever wants a service that is down to end the job
gives ``stop_after``: so many texts in a row whose calls raised are an error of the task, and with it of
the run or the micro-batch, which is then run again as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions import text as T
from foliospark.operators import calls
from foliospark.operators import chunks as C
from foliospark.operators.skew import join_one_per_key


def _answered(
    rows: DataFrame,
    fn: Callable,
    prompt: str,
    text: str,
    parallelism: int | None,
    max_attempts: int,
    backoff: float,
    texts_per_call: int,
    in_flight: int,
    stop_after: int | None,
) -> DataFrame:
    """``rows`` plus ``response`` (NULL: blank or failed) and ``error`` (NULL: no failure)."""
    if parallelism:
        rows = rows.repartition(parallelism)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    calling = calls.Calling(max_attempts, backoff, texts_per_call, in_flight, stop_after)
    task = calls.answer_column(fn, prompt, text, calling)
    return rows.mapInArrow(task, f"{columns}, response string, error string")


def translate_table(
    rows: DataFrame,
    fn: Callable,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    keys: tuple[str, ...] = ("doc_id", "chunk_idx"),
    text: str = "chunk",
    system_prompt: str | None = None,
    parallelism: int | None = None,
    max_attempts: int = K.MAX_ATTEMPTS,
    backoff: float = 2.0,
    texts_per_call: int = K.TEXTS_PER_CALL,
    in_flight: int = 1,
    stop_after: int | None = None,
) -> DataFrame:
    """One result per row; ``parallelism`` is the number of concurrent callers."""
    prompt = system_prompt or K.MARKDOWN_PROMPT.replace("{target_lang}", target_lang)
    answered = _answered(
        rows.select(*keys, F.col(text).alias("original")),
        fn, prompt, "original", parallelism, max_attempts, backoff, texts_per_call, in_flight, stop_after,
    )
    blank = T.is_blank(F.col("original"))
    success = blank | F.col("response").isNotNull()
    return answered.select(
        *keys,
        F.lit(target_lang).alias("target_lang"),
        "original",
        F.coalesce(T.strip(F.col("response")), F.lit("")).alias("translated"),
        success.alias("success"),
        F.when(success, "").otherwise(F.coalesce("error", F.lit(""))).alias("error"),
    )


def translate_single(rows: DataFrame, fn: Callable, target_lang: str = K.DEFAULT_TARGET_LANG, **options):
    """:func:`translate_table` with the prompt for plain text."""
    prompt = K.TEXT_PROMPT.replace("{target_lang}", target_lang)
    return translate_table(rows, fn, target_lang, system_prompt=prompt, **options)


def translate_distinct(
    rows: DataFrame,
    fn: Callable,
    commit_to: str,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    keys: tuple[str, ...] = ("doc_id", "chunk_idx"),
    text: str = "chunk",
    **options,
) -> DataFrame:
    """:func:`translate_table` that calls the function once per distinct text.

    ``rows`` are keyed once and written below ``commit_to``, as are the distinct results. Copies
    collapse map-side in a hash aggregation before the shuffle. The results are joined to the
    copies with every text salted; the join carries no original texts on the side of the copies.
    """
    text_key = F.coalesce(F.sha2(text, 256), F.lit("null"))
    keyed = rows.select(*keys, F.col(text).alias("original"), text_key.alias("text_key"))
    read = rows.sparkSession.read
    keyed.write.mode("overwrite").parquet(f"{commit_to}/keyed")
    keyed = read.schema(keyed.schema).parquet(f"{commit_to}/keyed")
    distinct = keyed.select("text_key", "original").distinct()
    results = translate_table(
        distinct, fn, target_lang, keys=("text_key",), text="original", **options
    )
    results.write.mode("overwrite").parquet(f"{commit_to}/results")
    committed = read.schema(results.schema).parquet(f"{commit_to}/results")
    joined = join_one_per_key(keyed.select(*keys, "text_key"), committed, "text_key", list(keys))
    return joined.select(*keys, "target_lang", "original", "translated", "success", "error")


def apply_results(chunks: DataFrame, results: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Chunks with their final text: the translation, or the original where that failed or is
    missing. ``keys`` includes the chunk index, so the join key has no hot values."""
    found = results.select(*keys, "translated", "success")
    return chunks.join(found, list(keys), "left").select(
        *chunks.columns,
        F.when(F.col("success"), F.col("translated")).otherwise(F.col("chunk")).alias("final"),
        F.coalesce(~F.col("success"), F.lit(True)).alias("fell_back"),
    )


def answer_documents(
    docs: DataFrame,
    fn: Callable,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    keys: tuple[str, ...] = ("doc_id",),
    content: str = "content",
    separator: str = K.PARAGRAPH_SEPARATOR,
    max_chars: int = K.MAX_CHARS,
    system_prompt: str | None = None,
    parallelism: int | None = None,
    max_attempts: int = K.MAX_ATTEMPTS,
    backoff: float = 2.0,
    texts_per_call: int = K.TEXTS_PER_CALL,
    in_flight: int = 1,
    stop_after: int | None = None,
) -> DataFrame:
    """Split, pack and send whole documents: ``keys, blank_source, chunks, answers``.

    The chunks of a document stay in its row as an array, so the texts are never shuffled:
    the plan is one scan, one Python stage and projections around it. Blank documents have no
    chunks, keep their text in ``blank_source`` and are not sent.
    """
    prompt = system_prompt or K.MARKDOWN_PROMPT.replace("{target_lang}", target_lang)
    rows = docs.select(*keys, F.col(content).alias("source"))
    if parallelism:
        rows = rows.repartition(parallelism)
    packed = C.with_chunks(rows, "source", separator, max_chars).select(
        *keys,
        F.when(T.is_blank(F.col("source")), F.col("source")).alias("blank_source"),
        F.when(~T.is_blank(F.col("source")), F.col("chunks")).alias("chunks"),
    )
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema.fields)
    calling = calls.Calling(max_attempts, backoff, texts_per_call, in_flight, stop_after)
    return packed.mapInArrow(
        calls.answer_lists(fn, prompt, "chunks", calling),
        f"{columns}, answers array<struct<response:string,error:string>>",
    )


def joined_documents(
    answered: DataFrame, keys: tuple[str, ...], target_lang: str, separator: str
) -> DataFrame:
    """The documents of :func:`answer_documents` put together, failed chunks as they were."""
    final = F.zip_with(
        "chunks",
        "answers",
        lambda c, a: F.when(T.is_blank(c), "")
        .when(a["response"].isNotNull(), T.strip(a["response"]))
        .otherwise(c),
    )
    failed = F.filter("answers", lambda a: a["error"].isNotNull())
    return answered.select(
        *keys,
        F.lit(target_lang).alias("target_lang"),
        F.coalesce(F.array_join(final, separator), F.col("blank_source")).alias("content"),
        F.when(F.col("answers").isNull(), 0).otherwise(F.size(failed)).alias("n_failed_chunks"),
    )


def result_rows(answered: DataFrame, keys: tuple[str, ...], target_lang: str) -> DataFrame:
    """The chunks of :func:`answer_documents` as one result row each, with ``chunk_key``."""
    pairs = F.arrays_zip("chunks", "answers")
    rows = answered.select(*keys, F.posexplode(pairs).alias("chunk_idx", "p"))
    answer, original = F.col("p.answers"), F.col("p.chunks")
    success = T.is_blank(original) | answer["response"].isNotNull()
    return rows.select(
        *keys,
        "chunk_idx",
        F.sha2(original, 256).alias("chunk_key"),
        F.lit(target_lang).alias("target_lang"),
        original.alias("original"),
        F.coalesce(T.strip(answer["response"]), F.lit("")).alias("translated"),
        success.alias("success"),
        F.when(success, "").otherwise(F.coalesce(answer["error"], F.lit(""))).alias("error"),
    )


def translate_markdown(
    docs: DataFrame,
    fn: Callable,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    keys: tuple[str, ...] = ("doc_id",),
    content: str = "content",
    separator: str = K.PARAGRAPH_SEPARATOR,
    max_chars: int = K.MAX_CHARS,
    **options,
) -> DataFrame:
    """Whole documents: split, pack, translate, fall back to the original, join; ``options`` are
    those of :func:`answer_documents`. Blank documents come back unchanged."""
    answered = answer_documents(docs, fn, target_lang, keys, content, separator, max_chars, **options)
    counted = answered.withColumn("n_chunks", F.coalesce(F.size("chunks"), F.lit(0)))
    whole = joined_documents(counted, (*keys, "n_chunks"), target_lang, separator)
    return whole.select(*keys, "target_lang", "content", "n_chunks", "n_failed_chunks")


def translate_batches(
    batches: DataFrame,
    fn: Callable,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    parallelism: int | None = None,
    max_attempts: int = K.MAX_ATTEMPTS,
    backoff: float = 2.0,
    texts_per_call: int = K.TEXTS_PER_CALL,
    in_flight: int = 1,
    stop_after: int | None = None,
) -> DataFrame:
    """Send packed batches; adds ``response`` and ``error`` for ``unpack_batches``."""
    prompt = K.BATCH_PROMPT.replace("{target_lang}", target_lang)
    return _answered(
        batches, fn, prompt, "combined", parallelism, max_attempts, backoff, texts_per_call, in_flight, stop_after
    )
