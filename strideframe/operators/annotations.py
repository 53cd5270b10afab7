"""Instruction annotations: the source texts of the samples plus configured paraphrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.config import AnnotationConfig
from strideframe.functions.ids import instruction_key
from strideframe.sources.small import literal_table

# fixed order of the annotation table
ANNOTATION_COLUMNS = [
    "instruction_id", "episode_id", "source_instruction_id", "source_instruction_text", "text", "annotation_type",
    "annotation_version", "annotation_policy", "language", "task_label", "object_label", "scene_label", "created_by",
    "created_at_utc", "is_active",
]
LABELS = ["task_label", "object_label", "scene_label"]

RULE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ("match_text", "text", "annotation_type")]
    + [T.StructField(name, T.StringType(), True) for name in LABELS]
    + [T.StructField("is_active", T.BooleanType(), False)]
)


def rule_table(spark: SparkSession, config: AnnotationConfig) -> DataFrame:
    """One row per configured text; empty but typed when there are no rules."""
    rows = [
        (rule.match_text, text, rule.annotation_type, *[getattr(rule, label) for label in LABELS], rule.is_active)
        for rule in config.rules
        for text in rule.texts
    ]
    return literal_table(spark, rows, RULE_SCHEMA)


def source_annotations(samples: DataFrame, config: AnnotationConfig) -> DataFrame:
    """Every distinct instruction of an episode, as an annotation of its own."""
    if config.require_status:
        samples = samples.where(F.col("sync_status") == config.require_status)
    identity = [
        F.col("episode_id").cast("string").alias("episode_id"),
        F.col("instruction_id").cast("string").alias("source_instruction_id"),
        F.col("instruction_text").cast("string").alias("source_instruction_text"),
    ]
    return (
        samples.where(F.col("instruction_text").isNotNull())
        .select(*identity)
        .distinct()
        .select(
            "*",
            F.col("source_instruction_text").alias("text"),
            F.lit(config.source_type).alias("annotation_type"),
            *[F.lit(getattr(config, label)).cast("string").alias(label) for label in LABELS],
            F.lit(True).alias("is_active"),
        )
    )


def paraphrase_annotations(sources: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule texts for every source annotation with exactly the rule's text."""
    source = sources.select("episode_id", "source_instruction_id", "source_instruction_text")
    return source.join(rules, F.col("source_instruction_text") == F.col("match_text")).drop("match_text")


def finish_annotations(rows: DataFrame, config: AnnotationConfig) -> DataFrame:
    """Version columns and hash id; of equal ids the active one with the smallest labels stays."""
    seed = [
        F.col("episode_id"),
        F.col("source_instruction_id"),
        F.col("text"),
        F.col("annotation_type"),
        F.lit(config.version),
        F.lit(config.policy),
    ]
    full = rows.select(
        instruction_key(seed).alias("instruction_id"),
        *[c for c in rows.columns if c != "is_active"],
        F.lit(config.version).alias("annotation_version"),
        F.lit(config.policy).alias("annotation_policy"),
        F.lit(config.language).alias("language"),
        F.lit(config.created_by).alias("created_by"),
        F.lit(config.created_at_utc).alias("created_at_utc"),
        F.coalesce(F.col("is_active"), F.lit(True)).alias("is_active"),
    )
    key = ["episode_id", "instruction_id"]
    rest = [c for c in ANNOTATION_COLUMNS if c not in key]
    preferred = F.struct((~F.col("is_active")).alias("_inactive"), *LABELS, *[c for c in rest if c not in LABELS])
    return (
        full.groupBy(*key)
        .agg(F.min(preferred).alias("_kept"))
        .select(*key, "_kept.*")
        .select(*ANNOTATION_COLUMNS)
    )


def annotations(samples: DataFrame, config: AnnotationConfig) -> DataFrame:
    """The annotation table (15 columns) of a synced table."""
    sources = source_annotations(samples, config)
    if not config.rules:
        return finish_annotations(sources, config)
    extra = paraphrase_annotations(sources, rule_table(samples.sparkSession, config))
    return finish_annotations(sources.unionByName(extra), config)


def active_annotations(table: DataFrame, active_only: bool = True, version: str | None = None) -> DataFrame:
    """Active rows of one version; a filter is left out when the table lacks its column."""
    if active_only and "is_active" in table.columns:
        table = table.where(F.col("is_active"))
    if version and "annotation_version" in table.columns:
        table = table.where(F.col("annotation_version") == version)
    return table


def type_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("annotation_type").agg(F.count(F.lit(1)).alias("annotations"))


def per_episode(table: DataFrame) -> DataFrame:
    return table.groupBy("episode_id").agg(F.count(F.lit(1)).alias("annotations")).orderBy("episode_id")


def per_episode_summary(table: DataFrame) -> DataFrame:
    """One row, zeros for an empty table."""
    counts = table.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return counts.agg(
        F.count("episode_id").alias("episodes"),
        F.coalesce(F.min("n"), zero).alias("min_annotations"),
        F.coalesce(F.max("n"), zero).alias("max_annotations"),
    )
