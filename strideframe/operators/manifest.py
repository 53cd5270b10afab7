"""The logical training index: one row per sample and instruction, no frame data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.config import FrameManifestConfig, ManifestConfig
from strideframe.functions.columns import col, first_present
from strideframe.functions.digest import content_digest
from strideframe.functions.ids import sample_key, task_key
from strideframe.operators.annotations import active_annotations
from strideframe.operators.ordering import sort_placed, sort_stored, with_global_index
from strideframe.sources import files

# fixed values: the columns of the two manifests
WINDOW_BOUNDS = ["observation_start_frame", "observation_end_frame", "action_start_frame", "action_end_frame"]
_SYNC_FIELDS = [
    "anchor_frame", *WINDOW_BOUNDS, "anchor_timestamp", "observation_start_timestamp", "observation_end_timestamp",
    "action_start_timestamp", "action_end_timestamp", "observation_rows", "action_rows", "max_timestamp_gap_seconds",
    "sync_status", "sync_rule", "source_frames_table", "source_frames_snapshot_id",
]
_ANNOTATION_FIELDS = {
    "instruction_id": "instruction_id",
    "text": "instruction_text",
    "annotation_type": "annotation_type",
    "annotation_version": "annotation_version",
    "annotation_policy": "annotation_policy",
    "language": "annotation_language",
    "task_label": "task_label",
    "object_label": "object_label",
    "scene_label": "scene_label",
}
ANNOTATED_COLUMNS = [
    "sample_id", "source_sample_id", "episode_id", "source_instruction_id", "source_instruction_text",
    *_ANNOTATION_FIELDS.values(), "annotation_table", "annotation_snapshot_id", *_SYNC_FIELDS,
]
PLAIN_COLUMNS = ["sample_id", "episode_id", "instruction_id", "instruction_text", *_SYNC_FIELDS]
# sorting by these is total on a manifest without repeated sample ids
MANIFEST_ORDER = ["episode_id", "anchor_frame", "instruction_id", "source_sample_id", "sample_id"]
# columns that name a particular table version; equal content in a rebuilt table keeps its digest without them
PROVENANCE = ["annotation_table", "annotation_snapshot_id", "source_frames_table", "source_frames_snapshot_id"]

# candidate column names, first one present wins
EPISODE_NAMES = ["episode_index", "episode_id", "episode"]
FRAME_NAMES = ["frame_index", "index"]
TASK_NAMES = ["task_index", "task_id"]
TEXT_NAMES = ["task.instructions", "task.policy"]


def required_status(samples: DataFrame, config: ManifestConfig) -> DataFrame:
    return samples.where(F.col("sync_status") == config.require_status) if config.require_status else samples


def _join_keys(config: ManifestConfig) -> list[tuple[str, str]]:
    """(synced column, annotation column); names other than the instruction are not join columns."""
    keys = [("episode_id", "episode_id")]
    if "source_instruction_id" in config.join_columns:
        keys.append(("instruction_id", "source_instruction_id"))
    return keys


def annotated_manifest(
    samples: DataFrame, annotations: DataFrame, config: ManifestConfig, snapshot_id: int | None = None
) -> DataFrame:
    """Every required sample once per matching annotation (33 columns).

    A plain inner join: adaptive execution picks broadcast by size and splits skewed episodes on either side.
    """
    s = required_status(samples, config)
    a = active_annotations(annotations, config.annotation_active_only, config.annotation_version)
    a = a.select(
        *[F.col(right).alias(f"_key{n}") for n, (_, right) in enumerate(_join_keys(config))],
        *[F.col(name).alias(f"_a_{name}") for name in _ANNOTATION_FIELDS],
    )
    on = [s[left] == F.col(f"_key{n}") for n, (left, _) in enumerate(_join_keys(config))]
    return s.join(a, on).select(
        sample_key(F.col("episode_id"), F.col("_a_instruction_id"), F.col("anchor_frame")).alias("sample_id"),
        F.col("sample_id").alias("source_sample_id"),
        "episode_id",
        F.col("instruction_id").alias("source_instruction_id"),
        F.col("instruction_text").alias("source_instruction_text"),
        *[F.col(f"_a_{name}").alias(out) for name, out in _ANNOTATION_FIELDS.items()],
        F.lit(config.annotation_table).alias("annotation_table"),
        F.lit(snapshot_id).cast("long").alias("annotation_snapshot_id"),
        *_SYNC_FIELDS,
    )


def plain_manifest(samples: DataFrame, config: ManifestConfig) -> DataFrame:
    """Required samples as they are; columns the table lacks are left out."""
    present = [name for name in PLAIN_COLUMNS if name in samples.columns]
    return required_status(samples, config).select(*present)


def frame_manifest(frames: DataFrame, config: FrameManifestConfig) -> DataFrame:
    """A manifest straight from raw frames, with stand-ins for columns the frames lack (9 columns)."""
    names = frames.columns

    def picked(candidates: list[str], default: str | None):
        name = first_present(names, candidates)
        return col(name) if name else F.lit(default)

    episode = picked(EPISODE_NAMES, "ep_unknown")
    if config.episodes:
        frames = frames.where(episode.try_cast("long").isin(*config.episodes))
    described = [
        episode.cast("string").alias("episode_id"),
        task_key(picked(TASK_NAMES, "inst_unknown")).alias("instruction_id"),
        picked(TEXT_NAMES, None).cast("string").alias("instruction_text"),
    ]
    frame_name = first_present(names, [*FRAME_NAMES, "timestamp"])
    if frame_name:
        anchors = frames.select(*described, col(frame_name).cast("long").alias("anchor_frame"))
    else:
        # a repeatable position among the columns that reach the manifest
        rows = frames.select(*described)
        anchors = with_global_index(rows, rows.columns, "anchor_frame")
    anchors = anchors.where(F.col("anchor_frame") % config.stride == 0)
    bounds = [
        (F.col("anchor_frame") + F.lit(offset)).alias(f"{role}_{side}_frame")
        for role, offsets in config.window.roles.items()
        for side, offset in zip(("start", "end"), offsets)
    ]
    return anchors.select(
        sample_key(F.col("episode_id"), F.col("instruction_id"), F.col("anchor_frame")).alias("sample_id"),
        *anchors.columns,
        *bounds,
    ).where(F.col("observation_start_frame") >= 0)


def manifest_order(manifest: DataFrame) -> list[str]:
    return [name for name in MANIFEST_ORDER if name in manifest.columns]


def sort_manifest(manifest: DataFrame) -> DataFrame:
    """Episode ids compare as text, so episode 10 comes before episode 2."""
    return sort_stored(manifest, manifest_order(manifest))


def manifest_digest(manifest: DataFrame) -> DataFrame:
    """Content version of a manifest, independent of layout and of table versions."""
    return content_digest(manifest, [name for name in manifest.columns if name not in PROVENANCE])


def json_lines(manifest: DataFrame) -> DataFrame:
    """The manifest as JSON documents; NULL fields are left out."""
    return manifest.select(F.to_json(F.struct(*[col(name) for name in manifest.columns])).alias("value"))


def write_json_lines(manifest: DataFrame, path: str) -> None:
    """Sorted JSON lines of a stored manifest in as many part files as the sort has partitions; file order is row order."""
    sort_placed(manifest, manifest_order(manifest)).write.mode("overwrite").json(path)


def _json_type(name: str) -> str:
    if name.endswith("_timestamp") or name.endswith("_seconds"):
        return "double"
    return "long" if name.endswith(("_frame", "_rows", "_snapshot_id")) else "string"


JSON_SCHEMA = ", ".join(f"{name} {_json_type(name)}" for name in ANNOTATED_COLUMNS)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """A manifest from its JSON lines, typed; columns a shorter manifest does not have are NULL."""
    return files.read_json_lines(spark, path, JSON_SCHEMA)


def expected_rows(samples: DataFrame, annotations: DataFrame | None, config: ManifestConfig) -> DataFrame:
    """Rows the manifest must have, from per-key counts instead of the join itself."""
    s = required_status(samples, config)
    if annotations is None:
        return s.agg(F.count(F.lit(1)).alias("expected_rows"))
    a = active_annotations(annotations, config.annotation_active_only, config.annotation_version)
    keys = _join_keys(config)
    left = s.groupBy(*[F.col(k).alias(f"_k{n}") for n, (k, _) in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_s"))
    right = a.groupBy(*[F.col(k).alias(f"_k{n}") for n, (_, k) in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_a"))
    pairs = left.join(right, [f"_k{n}" for n in range(len(keys))])
    return pairs.agg(F.coalesce(F.sum(F.col("_s") * F.col("_a")), F.lit(0)).alias("expected_rows"))
