"""Table summaries."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from strideframe.operators import annotations as A
from strideframe.operators.sync import status_counts
from strideframe.sources import files
from strideframe.sources.snapshots import SnapshotStore

# fixed values: the columns and keys of the reports
SAMPLE_PREVIEW = [
    "sample_id", "episode_id", "instruction_id", "anchor_frame", "anchor_timestamp", "observation_start_frame",
    "observation_end_frame", "action_start_frame", "action_end_frame", "observation_rows", "action_rows",
    "max_timestamp_gap_seconds", "sync_status",
]
ANNOTATION_PREVIEW = [
    "episode_id", "source_instruction_id", "instruction_id", "text", "annotation_type", "annotation_version",
    "annotation_policy", "task_label", "object_label", "scene_label", "is_active",
]


def preview_samples(samples: DataFrame, limit: int = 5) -> DataFrame:
    # the sample id breaks ties of duplicated anchors
    return samples.select(*SAMPLE_PREVIEW).orderBy("episode_id", "anchor_frame", "sample_id").limit(limit)


def preview_annotations(table: DataFrame, limit: int = 10) -> DataFrame:
    return table.select(*ANNOTATION_PREVIEW).orderBy("episode_id", "annotation_type", "instruction_id").limit(limit)


def _dicts(df: DataFrame) -> list[dict[str, Any]]:
    return [row.asDict() for row in df.collect()]


INFO_KEYS = [
    "codebase_version", "robot_type", "total_episodes", "total_frames", "total_tasks", "fps", "data_path", "video_path",
]


def snapshot_summary(spark: SparkSession, snapshot_dir: str, limit: int = 10) -> dict[str, Any]:
    """Description, file sizes and frame schema of a raw snapshot; lists show the first files by path."""
    info = files.read_document(spark, f"{snapshot_dir}/meta/info.json")
    summary: dict[str, Any] = {"info": {key: info[key] for key in INFO_KEYS if key in info}}
    for label, place in (("episodes", "meta/episodes"), ("frames", "data")):
        try:
            table = files.read_parquet_tree(spark, f"{snapshot_dir}/{place}")
        except FileNotFoundError:
            summary[label] = {"files": []}
            continue
        counted = files.file_row_counts(table)
        shown = _dicts(counted.orderBy("file_path").limit(limit))
        summary[label] = {"files": shown, "shown": len(shown), "total": counted.count(), "schema": table.dtypes}
    videos = files.list_files(spark, f"{snapshot_dir}/videos", "*.mp4")
    shown = _dicts(videos.orderBy("path").limit(limit))
    summary["videos"] = {"files": shown, "shown": len(shown), "count": videos.count()}
    return summary


def table_summary(store: SnapshotStore, table: str) -> dict[str, Any]:
    return {"rows": store.read(table).count(), "snapshots": _dicts(store.recent(table))}


def synced_summary(store: SnapshotStore, table: str, limit: int = 5) -> dict[str, Any]:
    samples = store.read(table)
    return {
        "table": table,
        "rows": samples.count(),
        "snapshot_id": store.latest_id(table),
        "sync_status_counts": {r["sync_status"]: r["samples"] for r in status_counts(samples).collect()},
        "samples": _dicts(preview_samples(samples, limit)),
    }


def annotation_summary(store: SnapshotStore, table: str, limit: int = 10) -> dict[str, Any]:
    rows = store.read(table)
    episodes = A.per_episode(rows)
    return {
        "table": table,
        "rows": rows.count(),
        "snapshot_id": store.latest_id(table),
        "annotation_type_counts": {r["annotation_type"]: r["annotations"] for r in A.type_counts(rows).collect()},
        "annotations_per_episode_summary": A.per_episode_summary(rows).first().asDict(),
        "annotations_per_episode_sample": _dicts(episodes.limit(limit)),
        "annotations_per_episode_total": episodes.count(),
        "samples": _dicts(preview_annotations(rows, limit)),
    }
