"""Translation memory: each distinct text is sent once for a prompt and language, ever.

A memory is a folder of results, written by run below the digest of prompt and language; several
output folders may share it. A look-up reads one such part only, and of that what the texts at hand ask for.
Results count once their write has committed. What two runs have sent at the same time is in it twice,
and the later success counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark import schemas
from foliospark.functions import text as T
from foliospark.operators import translate as TR
from foliospark.operators.skew import join_one_per_key
from foliospark.sources.tables import exists, small_broadcast, write_texts


def text_key(text):
    """The key of a text: its SHA-256, as ``chunk_key`` elsewhere."""
    return F.sha2(text, 256)


@dataclass(frozen=True)
class TranslationMemory:
    spark: SparkSession
    folder: str

    def part(self, prompt: str, target_lang: str) -> str:
        digest = hashlib.sha256(f"{target_lang}\0{prompt}".encode()).hexdigest()
        return f"{self.folder.rstrip('/')}/prompt_key={digest}"

    def results(self, prompt: str, target_lang: str) -> DataFrame:
        """Everything sent for this prompt and language, a row per text and run."""
        path = self.part(prompt, target_lang)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schemas.MEMORY)
        return self.spark.read.schema(schemas.MEMORY).parquet(path)

    def sent(self, run_id: str, prompt: str, target_lang: str) -> DataFrame:
        """What one run has sent."""
        return self.results(prompt, target_lang).filter(F.col("run_id") == run_id)


def translate_remembered(
    chunks: DataFrame,
    fn: Callable,
    memory: TranslationMemory,
    run_id: str,
    work: str,
    target_lang: str = K.DEFAULT_TARGET_LANG,
    keys: tuple[str, ...] = ("doc_id", "chunk_idx"),
    text: str = "chunk",
    system_prompt: str | None = None,
    **options,
) -> DataFrame:
    """One result per row, as :func:`translate_table` gives, with ``chunk_key`` and ``reused``.

    Sends only texts that the memory has no success for, each once, and adds the results to it
    in one commit. A text that failed fails all its rows of this run and is sent again by the next. A run may come
    in slices, by several calls with its ``run_id``: what one has sent, the others do not. Blank texts are not sent.

    Which texts are unknown is decided on keys alone; only their texts are shuffled, copies being
    collapsed by the tasks that read them. Results go to the copies with every key dealt to salts, so
    a text of a third of all rows is no hot key. ``work`` is a fresh folder for the keyed
    rows, so that what makes ``chunks`` runs once.
    """
    spark = chunks.sparkSession
    prompt = system_prompt or K.MARKDOWN_PROMPT.replace("{target_lang}", target_lang)
    original = F.col("original")
    keyed = chunks.select(*keys, F.col(text).alias("original")).select(
        "*", text_key(original).alias("chunk_key"), T.is_blank(original).alias("_blank")
    )
    write_texts(keyed, f"{work}/keyed")
    keyed = spark.read.schema(keyed.schema).parquet(f"{work}/keyed")
    full = keyed.filter(~F.col("_blank"))

    asked = full.select("chunk_key").distinct()
    asked.write.parquet(f"{work}/asked")
    asked = spark.read.schema(asked.schema).parquet(f"{work}/asked")
    own = F.col("run_id") == run_id
    earlier = memory.results(prompt, target_lang).filter(F.col("success") | own)
    unknown = asked.join(earlier.select("chunk_key"), "chunk_key", "left_anti")
    unknown.write.parquet(f"{work}/unknown")
    unknown = spark.read.schema(unknown.schema).parquet(f"{work}/unknown")
    if not unknown.isEmpty():
        once = full.select("chunk_key", "original").distinct()
        once = once.join(small_broadcast(unknown), "chunk_key", "left_semi")
        made = TR.translate_table(
            once, fn, target_lang, keys=("chunk_key",), text="original", system_prompt=prompt, **options
        )
        made = made.select("chunk_key", "original", "translated", "success", "error")
        write_texts(made, f"{memory.part(prompt, target_lang)}/run_id={run_id}", "append")

    # The run's own results and earlier successes, one for each key.
    mine = memory.results(prompt, target_lang).filter(F.col("success") | own)
    answer = F.max_by(
        F.struct("original", "translated", "success", "error", (~own).alias("reused")),
        F.struct("success", "run_id"),
    )
    found = mine.join(small_broadcast(asked), "chunk_key", "left_semi").groupBy("chunk_key").agg(answer.alias("a"))
    found = found.select("chunk_key", "a.*")
    joined = join_one_per_key(full.select(*keys, "chunk_key"), found, "chunk_key", list(keys))
    empty = keyed.filter("_blank").select(
        *keys, "chunk_key", "original", F.lit("").alias("translated"), F.lit(True).alias("success"),
        F.lit("").alias("error"), F.lit(False).alias("reused"),
    )
    return joined.unionByName(empty).select(
        *keys, "chunk_key", F.lit(target_lang).alias("target_lang"), "original", "translated", "success", "error",
        "reused",
    )


def documents_of(results: DataFrame, keys: tuple[str, ...], separator: str) -> DataFrame:
    """The documents of chunk results put together, failed chunks as they were.

    A document came out of one cell and goes back into one, so a group is bounded by the cell size.
    """
    final = F.when(F.col("success"), F.col("translated")).otherwise(F.col("original"))
    pairs = F.array_sort(F.collect_list(F.struct("chunk_idx", final.alias("final"))))
    grouped = results.groupBy(*keys, "target_lang").agg(
        pairs.alias("pairs"), F.count_if(~F.col("success")).cast("int").alias("n_failed_chunks")
    )
    return grouped.select(
        *keys, "target_lang", F.array_join("pairs.final", separator).alias("content"), "n_failed_chunks",
        F.size("pairs").alias("n_chunks"),
    )
