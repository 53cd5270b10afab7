"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.llm import (
    archive, byte_bpe, decontamination, mixing, near_dedup, periodic, quality, search, secret_scan, span_dedup, toxicity,
    url_filter, whitening,
)
from strideframe.llm.oracles import ORACLES
from strideframe.llm.shipping import ship
from strideframe.sources import scratch


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf, "documents"))


def op2_content_archive(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch.new_path(spark, "archive")
    archive.write_archive(_table(spark, sf, "pages"), folder)
    header, payload = F.col("header"), F.col("payload")
    refers = F.regexp_extract(archive.header_field(header, "WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1)
    return archive.read_archive(spark, folder).select(
        F.col("id").alias("page_id"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        archive.base32_of_hex(F.sha1(payload)).alias("payload_digest"),
        archive.header_field(header, "WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
    )


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    content = byte_bpe.read_vocabulary(VOCABULARY)
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return byte_bpe.encode(docs, content, add=("n_tokens", "ids_sha256", "decoded_sha256"), drop=("text",))


def op4_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents").select("doc_id", "text", "source")).selectExpr(
        "doc_id", "mix_size as size", "mix_source_size as source_size", "mix_target as target", "mix_size * mix_copies as taken"
    )


def op5_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return search.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return toxicity.score_texts(_table(spark, sf, "documents"), _table(spark, sf, "labels"), held_out)


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "soft_weight"
    )


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return span_dedup.remove_repeats(_table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.col("secret_spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(some):
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.KINDS[: secret_scan.BASE_KINDS]))
    return secret_scan.scan(_table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"),
    )


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf, "embeddings"))


def op12_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def _planted_period(id: Column, text: Column) -> Column:
    """The text, with a periodic tail where crc32 of the id ends in 0 (a fixed part of the query's contract)."""
    h = F.crc32(id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def rewritten(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), quality.SPACES), lambda w: w != "")
    return F.when(h % 10 == 0, quality.let(words, rewritten)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", _planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    runs = F.col("runs")
    longest = F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0), lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best)
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (
        periodic.collapse_runs(docs)
        .withColumn("most", longest)
        .select(
            "doc_id", F.size(runs).cast("long").alias("n_runs"), "most.start", "most.length", "most.period",
            F.floor(1000 * F.col("most.length") / F.col("most.period")).cast("long").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_content_archive, op3_byte_bpe, op4_source_mixing, op5_exact_top_k, op6_toxicity,
        op7_url_filter, op8_substring_dedup, op9_quality_rules, op10_secret_scan,
        op11_embedding_whitening, op12_decontamination, op13_periodic_runs,
    )
}
