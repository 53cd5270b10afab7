"""From raw documents to token ids: five stages, each an operator of the llm package over all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.llm import byte_bpe, mixing, near_dedup, quality, secret_scan
from strideframe.llm.arrow import text_batches
from strideframe.llm.queries import VOCABULARY
from strideframe.llm.shipping import ship
from strideframe.sources import scratch


def _workers(spark: SparkSession) -> None:
    """Python workers find the package and get texts in small batches, as several stages share an executor's memory."""
    ship(spark)
    text_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays, that with the smallest id."""
    _workers(spark)
    return near_dedup.keep_one(docs, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked; every document stays."""
    _workers(spark)
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate asks."""
    return mixing.emit(mixing.mix(docs))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` and the digest of the decoded bytes, for each copy the mix took."""
    _workers(spark)
    content = byte_bpe.read_vocabulary(VOCABULARY)
    rows = docs.select("doc_id", "lang", "source", "text")
    return byte_bpe.encode(rows, content, add=("n_tokens", "ids", "decoded_sha256"), drop=("text",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

#: BPE, MinHash and key parsing have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
