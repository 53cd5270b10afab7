"""Frame table operators: projection, episode filter, task texts, derived episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.config import EpisodeFilter, FrameColumns
from strideframe.functions.columns import col, require_columns
from strideframe.functions.ids import task_key
from strideframe.sources.small import literal_table


def filter_episodes(df: DataFrame, column: str, chosen: EpisodeFilter) -> DataFrame:
    """Keep the chosen episodes: a range is a pushed predicate, a list of any length a semi join with the listed ids."""
    episode = col(column).cast("long")
    if not chosen.episodes:
        if chosen.count <= 0:
            return df
        return df.where(episode.between(chosen.start, chosen.start + chosen.count - 1))
    return df.join(listed_episodes(df.sparkSession, chosen), episode == F.col("_listed"), "left_semi")


def listed_episodes(spark: SparkSession, chosen: EpisodeFilter) -> DataFrame:
    """The listed ids as a table of known size, each once."""
    return literal_table(spark, [(e,) for e in sorted(set(chosen.episodes))], "_listed long")


def select_frames(frames: DataFrame, columns: FrameColumns, chosen: EpisodeFilter = EpisodeFilter()) -> DataFrame:
    """The narrow, typed view every later step reads: six columns whatever the source calls them."""
    require_columns(frames, columns.required)

    def optional(name: str | None, kind: str):
        return (col(name) if name in frames.columns else F.lit(None)).cast(kind)

    kept = filter_episodes(frames, columns.episode, chosen)
    return kept.select(
        col(columns.episode).cast("long").alias("episode"),
        col(columns.frame).cast("long").alias("frame"),
        col(columns.timestamp).cast("double").alias("ts"),
        col(columns.task).cast("long").alias("task"),
        optional(columns.instruction, "string").alias("instruction_text"),
        optional(columns.sensor_timestamp, "long").alias("sensor_ts"),
    )


def attach_task_text(frames: DataFrame, tasks: DataFrame | None) -> DataFrame:
    """Fill a missing instruction text from the task table, else with ``task_<n>``.

    No broadcast hint: Spark broadcasts the task table when its size allows and joins by shuffle otherwise.
    """
    own, fallback = F.col("instruction_text"), task_key(F.col("task"))
    if tasks is None or not {"task_index", "task"} <= set(tasks.columns):
        return frames.withColumn("instruction_text", F.coalesce(own, fallback))
    lookup = tasks.groupBy(F.col("task_index").cast("long").alias("task")).agg(
        F.min(F.col("task").cast("string")).alias("_task_text")
    )
    return frames.join(lookup, "task", "left").select(
        *[
            F.coalesce(own, F.col("_task_text"), fallback).alias(name) if name == "instruction_text" else F.col(name)
            for name in frames.columns
        ]
    )


def derive_episodes(frames: DataFrame) -> DataFrame:
    """One row per episode, from the frames alone."""
    require_columns(frames, ["episode_index"])
    optional = {
        "timestamp": [F.min("timestamp").alias("start_timestamp"), F.max("timestamp").alias("end_timestamp")],
        "frame_index": [
            F.min("frame_index").cast("long").alias("start_frame"),
            F.max("frame_index").cast("long").alias("end_frame"),
        ],
        "task_index": [F.sort_array(F.collect_set("task_index")).alias("task_indices")],
    }
    measures = [m for name, ms in optional.items() if name in frames.columns for m in ms]
    totals = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), *measures)
    return totals.orderBy("episode_index")
