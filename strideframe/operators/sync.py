"""Synchronised samples: anchors, their window statistics and quality flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.config import SyncConfig
from strideframe.functions.ids import sample_key, task_key
from strideframe.operators.frames import attach_task_text, select_frames
from strideframe.operators.windows import AnchorGrid, attach_statistics, statistic_names

# fixed order of the synced table
ANCHOR_COLUMNS = [
    "sample_id", "episode_id", "anchor_frame", "anchor_timestamp", "anchor_sensor_timestamp", "instruction_id",
    "instruction_text", "observation_start_frame", "observation_end_frame", "action_start_frame", "action_end_frame",
    "expected_observation_rows", "expected_action_rows", "source_frames_table", "source_frames_snapshot_id",
    "sync_rule",
]
QUALITY_COLUMNS = [
    "observation_missing_rows", "action_missing_rows", "max_timestamp_gap_seconds", "min_timestamp_gap_seconds",
    "sync_status", "max_allowed_timestamp_gap_seconds", "is_window_complete", "is_timestamp_monotonic",
    "is_gap_within_threshold",
]
SYNCED_COLUMNS = [
    *ANCHOR_COLUMNS,
    *statistic_names("observation"),
    *statistic_names("action"),
    *QUALITY_COLUMNS,
]


def grid_of(config: SyncConfig) -> AnchorGrid:
    return AnchorGrid(config.stride, config.window)


def anchor_samples(
    frames: DataFrame, tasks: DataFrame | None, config: SyncConfig, snapshot_id: int | None = None
) -> DataFrame:
    """Every stride-th frame whose observation window does not start before frame 0.

    Windows past the last frame stay: they are flagged later. ``episode`` and ``task`` are kept for joining.
    """
    roles = config.window.roles
    bounds = [
        f"frame + ({offset}) as {role}_{side}_frame"
        for role, offsets in roles.items()
        for side, offset in zip(("start", "end"), offsets)
    ]
    sizes = [f"{high - low + 1}L as expected_{role}_rows" for role, (low, high) in roles.items()]
    on_stride = frames.where(
        f"frame % {config.stride} = 0 and frame + ({config.window.observation_start_offset}) >= 0"
    )
    keyed = attach_task_text(on_stride, tasks).withColumn("instruction_id", task_key(F.col("task")))
    return keyed.select(
        "episode",
        "task",
        sample_key(F.col("episode"), F.col("instruction_id"), F.col("frame")).alias("sample_id"),
        F.expr("string(episode) as episode_id"),
        F.expr("frame as anchor_frame"),
        F.expr("ts as anchor_timestamp"),
        F.expr("sensor_ts as anchor_sensor_timestamp"),
        "instruction_id",
        "instruction_text",
        *[F.expr(text) for text in bounds + sizes],
        F.lit(config.source_table).alias("source_frames_table"),
        F.lit(snapshot_id).cast("long").alias("source_frames_snapshot_id"),
        F.lit(config.sync_rule).alias("sync_rule"),
    )


def add_quality(samples: DataFrame, max_gap_seconds: float) -> DataFrame:
    """Missing rows, gap extremes, one status (the first fault found) and three flags."""

    def gaps(kind: str) -> str:
        return ", ".join(f"coalesce({role}_{kind}_timestamp_gap_seconds, 0D)" for role in ("observation", "action"))

    measured = samples.selectExpr(
        "*",
        "expected_observation_rows - observation_rows as observation_missing_rows",
        "expected_action_rows - action_rows as action_missing_rows",
        f"greatest({gaps('max')}) as max_timestamp_gap_seconds",
        f"least({gaps('min')}) as min_timestamp_gap_seconds",
        f"double('{float(max_gap_seconds)!r}') as max_allowed_timestamp_gap_seconds",
    )
    status = """case
        when greatest(observation_missing_rows, action_missing_rows) > 0 then 'missing_window_rows'
        when min_timestamp_gap_seconds < 0 then 'non_monotonic_timestamp'
        when max_timestamp_gap_seconds > max_allowed_timestamp_gap_seconds then 'timestamp_gap_exceeded'
        else 'ok' end"""
    return measured.selectExpr(
        "*",
        f"{status} as sync_status",
        "observation_missing_rows = 0 and action_missing_rows = 0 as is_window_complete",
        "min_timestamp_gap_seconds >= 0 as is_timestamp_monotonic",
        "max_timestamp_gap_seconds <= max_allowed_timestamp_gap_seconds as is_gap_within_threshold",
    )


def synced_samples(
    frames: DataFrame, tasks: DataFrame | None, config: SyncConfig, snapshot_id: int | None = None
) -> DataFrame:
    """The synced table (41 columns) from a raw frames table."""
    narrow = select_frames(frames, config.columns, config.episodes)
    anchors = anchor_samples(narrow, tasks, config, snapshot_id)
    measured = attach_statistics(anchors, narrow, grid_of(config))
    return add_quality(measured, config.max_gap_seconds).select(*SYNCED_COLUMNS)


def window_statistics(frames: DataFrame, tasks: DataFrame | None, config: SyncConfig) -> DataFrame:
    """One row per sample id with the eight statistics of each window."""
    narrow = select_frames(frames, config.columns, config.episodes)
    measured = attach_statistics(anchor_samples(narrow, tasks, config), narrow, grid_of(config))
    names = ["sample_id", *statistic_names("observation"), *statistic_names("action")]
    return measured.select(*names).dropDuplicates(["sample_id"])


def status_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("sync_status").agg(F.count(F.lit(1)).alias("samples"))


def sync_summary(samples: DataFrame) -> DataFrame:
    """One row: number of samples and the widest gap seen."""
    return samples.agg(
        F.count(F.lit(1)).alias("synced_samples"),
        F.max("max_timestamp_gap_seconds").alias("max_observed_timestamp_gap_seconds"),
    )
