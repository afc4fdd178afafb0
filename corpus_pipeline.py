"""From raw documents to token counts: five stages, each written before the next one reads it.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bpe, decontaminate, near_dedup, quality_rules, secret_scan
from foliospark.llm.common import fresh
from foliospark.llm.queries import vocabulary_path
from foliospark.session import shared_path

# No single SQL statement gives the rows: secrets with checksums and BPE cannot be said in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null texts have no words and go too."""
    into = fresh(docs, "quality")
    return quality_rules.rate_quality(docs, into=into).filter(F.col(into)["kept"]).drop(into)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that with the smallest id."""
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item stands go."""
    into = fresh(docs, "contamination")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, into=into)
    return found.filter(F.col(into)["n_hit"] == 0).drop(into)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; a mark takes the place of each secret and ``n_chars`` follows."""
    into = fresh(docs, "redacted")
    cleaned = secret_scan.redact_secrets(docs, into=into)
    changed = {"text": F.col(into)["text"]}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed["n_chars"] = F.when(
            F.col(into)["n"] > 0, F.length(F.col(into)["text"]).cast(kind)
        ).otherwise(F.col("n_chars"))
    return cleaned.withColumns(changed).drop(into)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and the digests of ids and decoded text of each document."""
    found = bpe.round_trip(docs.select("doc_id", "text"), vocabulary_path())
    return found.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = shared_path(spark, "corpus-pipeline")
    for i, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{work}/{i}-{name}")
        docs = spark.read.schema(made.schema).parquet(f"{work}/{i}-{name}")
    return docs
