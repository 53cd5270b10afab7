"""The whole build over the conversations, written as a raw snapshot and run once for each data folder."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as X
from strideframe.config import AnnotationConfig, FrameManifestConfig, ManifestConfig, SyncConfig, WindowSpec
from strideframe.plans.build import BuildSettings, frame_manifest_step, run_build
from strideframe.sources import files, scratch
from strideframe.sources.snapshots import SnapshotStore

CHUNK = 1000
EXPORT_CHUNK = 64
TEMPLATE = "videos/chunk-{episode_chunk:03d}/{video_key}/all.mp4"
CAMERA = "observation.images.front"
SYNC = SyncConfig(stride=2, window=WindowSpec(-1, 0, 1, 1), max_gap_seconds=5.0)
ANNOTATE = AnnotationConfig(
    version="ann_v1", policy="source_and_rules", created_at_utc=X.CREATED_AT, task_label="shopping",
    object_label="item", scene_label="shop", rules=(), require_status="ok",
)

_built: dict[tuple[str, str], tuple[BuildSettings, dict[str, Any]]] = {}


def _touch(spark: SparkSession, path: str) -> None:
    """A file of one byte with a given name (empty files are not listed)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    out.write(0)
    out.close()


def write_snapshot(spark: SparkSession, sf: str, root: str) -> None:
    """Every turn as a frame, one metadata row per conversation, one video file for every 1000 conversations."""
    turns = X.turn_frames(spark, sf).select(
        "episode_index", "frame_index", "timestamp", "task_index",
        F.array(F.length("`task.instructions`").cast("double")).alias("observation.state"),
        F.array(F.col("timestamp")).alias("action"),
    )
    turns.write.parquet(f"{root}/data")
    stored = spark.read.parquet(f"{root}/data")
    episodes = stored.groupBy("episode_index").agg(F.count("*").alias("length"))
    episodes.write.json(f"{root}/meta/episodes.jsonl")
    X.task_table(spark).write.json(f"{root}/meta/tasks.jsonl")
    totals = episodes.agg(F.count("*"), F.sum("length"), F.max("episode_index")).first()
    vector = {"dtype": "float64", "shape": [1]}
    files.write_document(
        spark,
        f"{root}/meta/info.json",
        {
            "codebase_version": "v2.1", "robot_type": "none", "total_episodes": totals[0], "total_frames": totals[1],
            "total_tasks": len(X.TASKS), "fps": 1, "video_path": TEMPLATE, "chunks_size": CHUNK,
            "features": {"observation.state": vector, "action": vector, CAMERA: {"dtype": "video", "shape": [1, 1, 3]}},
        },
    )
    for chunk in range((totals[2] or 0) // CHUNK + 1):
        _touch(spark, f"{root}/{TEMPLATE.format(episode_chunk=chunk, video_key=CAMERA)}")


def built(spark: SparkSession, sf: str) -> tuple[BuildSettings, dict[str, Any]]:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        root = scratch.new_path(spark, "whole-build")
        write_snapshot(spark, sf, f"{root}/snapshot")
        settings = BuildSettings(
            dataset_name="conversations", snapshot_dir=f"{root}/snapshot", warehouse_dir=f"{root}/warehouse",
            registry_dir=f"{root}/registry", export_dir=f"{root}/export", sync=SYNC, annotation=ANNOTATE,
            manifest=ManifestConfig(annotation_version="ann_v1", join_columns=("episode_id", "source_instruction_id")),
            export_chunk_rows=EXPORT_CHUNK,
        )
        _built[key] = settings, run_build(spark, settings)
    return _built[key]


FRAMES_ONLY = FrameManifestConfig(stride=2, window=WindowSpec(-1, 0, 1, 1))
_from_frames: dict[tuple[str, str], tuple[SnapshotStore, str]] = {}


def from_frames(spark: SparkSession, sf: str) -> tuple[SnapshotStore, str]:
    """The store and registry of a manifest built straight from the frames of the snapshot."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _from_frames:
        settings, _ = built(spark, sf)
        root = scratch.new_path(spark, "frame-manifest")
        store = SnapshotStore(spark, f"{root}/warehouse")
        frame_manifest_step(store, "conversations", settings.snapshot_dir, f"{root}/registry", FRAMES_ONLY)
        _from_frames[key] = store, f"{root}/registry"
    return _from_frames[key]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``document, field, value`` of what a build says about its origin and size, but for ids, times and paths."""
    settings, _ = built(spark, sf)
    _, registry = from_frames(spark, sf)
    fields = {
        "sync_lineage": ["dataset_name", "source_table", "target_table", "sync_config_sha256", "stride", "sync_rule"],
        "sync_stats": ["synced_samples"],
        "annotation_lineage": ["annotation_config_sha256", "annotation_policy", "annotation_version", "require_sync_status", "source_table", "target_table"],
        "annotation_stats": ["annotations"],
        "lineage": ["source_type", "source_table", "annotation_table", "annotation_version", "require_sync_status", "source_total_frames"],
        "stats": ["manifest_rows"],
        "metadata": ["format"],
        "frames/lineage": ["source_type", "frame_stride", "frame_manifest_config_sha256", "source_total_episodes"],
        "frames/stats": ["manifest_rows"],
    }
    parts = []
    for document, names in fields.items():
        place, name = (registry, document.split("/")[1]) if "/" in document else (settings.registry_dir, document)
        read = spark.read.text(f"{place}/{name}.json", wholetext=True)
        values = [F.struct(F.lit(n).alias("field"), F.get_json_object("value", f"$.{n}").alias("value")) for n in names]
        parts.append(read.select(F.lit(document).alias("document"), F.inline(F.array(*values))))
    return reduce(DataFrame.union, parts)


#: the number that a check has looked at, by its name in the details
COUNTED = (
    "rows", "actual_rows", "jsonl_rows", "manifest_rows", "non_required_rows", "duplicate_samples", "duplicate_annotations",
    "missing_required_rows", "failed_quality_flag_count", "invalid_windows", "faulty_episodes", "mismatch_count", "missing_tasks",
    "missing_refs",
)


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The check rows of the three reports, as the build has stored them, each with the number it looked at."""
    settings, summary = built(spark, sf)
    rows = "checks array<struct<suite: string, name: string, status: string, details: string>>"
    names = ("contract_report", "validation_report", "exports/validation_report")
    reports = [f"{settings.registry_dir}/{name}.json" for name in names]
    counted = F.coalesce(*[F.get_json_object("details", f"$.{n}").cast("long") for n in COUNTED])
    return spark.read.schema(rows).json(reports).select(F.inline("checks")).select("suite", "name", "status", counted.alias("counted"))
