"""Materialised training rows and their side tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.columns import col
from strideframe.operators.locators import FILE, ROW, placed, rows_at
from strideframe.operators.manifest import WINDOW_BOUNDS, manifest_order
from strideframe.operators.ordering import with_global_index
from strideframe.operators.resolve import (
    ROLES,
    action_columns,
    frame_keys,
    match_windows,
    observation_columns,
    role_spans,
)
from strideframe.operators.video import refs_by_episode
from strideframe.sources import scratch

# fixed order of the descriptive part of a data row; the two index blocks follow
_DESCRIPTION = [
    "sample_id", "source_sample_id", "source_episode_id", "source_instruction_id", "source_instruction_text",
    "instruction_id", "annotation_type", "annotation_version", "annotation_policy", "annotation_language",
    "task_label", "object_label", "scene_label", "annotation_table", "annotation_snapshot_id", "source_anchor_frame",
    "observation_start_frame", "observation_end_frame", "action_start_frame", "action_end_frame", "observation_rows",
    "action_rows", "anchor_timestamp", "max_timestamp_gap_seconds", "sync_status", "sync_rule", "source_frames_table",
    "source_frames_snapshot_id",
]
_EPISODE_LINKS = [
    "sample_id", "source_sample_id", "source_episode_id", "source_instruction_id", "instruction_id",
    "annotation_type", "annotation_version", "annotation_policy", "source_anchor_frame", "observation_start_frame",
    "observation_end_frame", "action_start_frame", "action_end_frame",
]
# export name -> manifest name, and the stand-in when the manifest lacks it
_RENAMED = {"source_episode_id": "episode_id", "source_anchor_frame": "anchor_frame"}
_FALLBACK = {"source_sample_id": "sample_id", "source_instruction_id": "instruction_id"}
_LONGS = {
    "annotation_snapshot_id", "source_frames_snapshot_id", "observation_rows", "action_rows",
}
_DOUBLES = {"anchor_timestamp", "max_timestamp_gap_seconds"}
_PAIR = ["episode_id", *WINDOW_BOUNDS]
_INDEX_NAMES = {"frame_index", "episode_index", "index", "task_index"}

#: the folder of the rows whose index divided by the chunk size is ``chunk_index``; its part files are in index order
DATA_PATH = "data/chunk_index={chunk_index}"
CHUNK_ROWS = 1_000_000
DEFAULT_CODEBASE_VERSION = "v3.0"
EXPORT_FORMAT = "manifest_export_v0"


def index_manifest(manifest: DataFrame) -> DataFrame:
    """The manifest with its 0-based ``index`` in manifest order."""
    return with_global_index(manifest, manifest_order(manifest), "index")


def _described(manifest: DataFrame, name: str) -> Column:
    source = _RENAMED.get(name, name)
    if source not in manifest.columns and name in _FALLBACK:
        source = _FALLBACK[name]
    if source in manifest.columns:
        return F.col(source).alias(name)
    kind = "long" if name in _LONGS else "double" if name in _DOUBLES else "string"
    return F.lit(None).cast(kind).alias(name)


def _instruction() -> Column:
    return F.coalesce(F.col("instruction_text"), F.lit(""))


def export_tasks(indexed: DataFrame) -> DataFrame:
    """``task_index, task``: instruction texts numbered by their first appearance; no text is ``""``."""
    first = indexed.groupBy(_instruction().alias("task")).agg(F.min("index").alias("_first"))
    return with_global_index(first, ["_first"], "task_index").select("task_index", "task")


def boundary_rows(manifest: DataFrame, frames: DataFrame) -> DataFrame:
    """``observation`` (last frame) and ``action`` (first frame) records of every distinct pair of windows.

    The frames are chosen on the narrow key columns, with their place in the stored table; wide columns are read for the
    chosen places alone, and only those rows are shuffled. Rows that repeat a frame number are told apart by timestamp, then by place.
    """
    stored = placed(frames)
    episode, frame = frame_keys(frames)
    stamp = col("timestamp") if "timestamp" in frames.columns else F.lit(None).cast("double")
    names = sorted(set(observation_columns(frames.columns)) | set(action_columns(frames.columns)))
    windows = manifest.select(*_PAIR).distinct().select(*_PAIR, role_spans())
    narrow = stored.select(episode, frame, stamp.alias("_ts"), FILE, ROW)
    matched = match_windows(windows, narrow, [F.col(n) for n in ("_ts", FILE, ROW)])
    spot = F.struct("frame", "_ts", FILE, ROW)
    edges = matched.groupBy(*_PAIR, "role").agg(F.max(spot).alias("_last"), F.min(spot).alias("_first"))
    chosen = F.when(F.col("role") == "observation", F.col("_last")).otherwise(F.col("_first")).alias("_spot")
    chosen = scratch.store(edges.select(*_PAIR, "role", chosen).select(*_PAIR, "role", f"_spot.{FILE}", f"_spot.{ROW}"), "boundaries")
    wide = stored.select(FILE, ROW, F.struct(*[col(n) for n in names]).alias("record"))
    records = [F.first(F.when(F.col("role") == role, F.col("record")), ignorenulls=True).alias(role) for role in ROLES]
    return chosen.join(rows_at(wide, chosen.select(FILE, ROW)), [FILE, ROW]).groupBy(*_PAIR).agg(*records)


def export_rows(indexed: DataFrame, tasks: DataFrame, frames: DataFrame) -> DataFrame:
    """One training row per manifest row: description, index columns, last observation, first action.

    A sample with an empty window is an error, not a dropped row.
    """
    edges = boundary_rows(indexed, frames).select(
        *[F.col(name).alias(f"_{name}") for name in _PAIR], *[F.col(role).alias(f"_{role}") for role in ROLES]
    )
    on = [F.col(name) == F.col(f"_{name}") for name in _PAIR]
    rows = indexed.join(edges, on, "left")
    lookup = tasks.select("task_index", F.col("task").alias("_task"))
    rows = rows.join(lookup, _instruction() == F.col("_task"), "left")

    def edge_field(role: str, name: str) -> Column:
        message = F.concat(F.lit(f"{role} window is empty: "), F.col("sample_id"))
        known = F.when(F.col(f"_{role}").isNull(), F.raise_error(message)).otherwise(F.col(f"_{role}"))
        return known[name].alias(name)

    values = [edge_field("observation", n) for n in frames.columns if n.startswith("observation.")]
    values += [edge_field("action", n) for n in frames.columns if n == "action" or n.startswith("action.")]
    # the sample id carries the check as well, so that no projection can lose it
    both = F.col("_observation").isNotNull() & F.col("_action").isNotNull()
    checked = F.when(both, F.col("sample_id")).otherwise(
        F.raise_error(F.concat(F.lit("a window is empty: "), F.col("sample_id")))
    )
    description = [checked.alias(n) if n == "sample_id" else _described(indexed, n) for n in _DESCRIPTION]
    return rows.select(
        *description,
        F.col("_observation")["timestamp"].alias("timestamp"),
        F.lit(0).cast("long").alias("frame_index"),
        F.col("index").alias("episode_index"),
        F.col("index").alias("index"),
        "task_index",
        F.col("instruction_text").alias("task.instructions"),
        *values,
    )


def chunk_of(chunk_rows: int) -> Column:
    """The numbered folder a row belongs to, by its index."""
    return F.floor(F.col("index") / chunk_rows).cast("long")


def data_folder(chunk_rows: int) -> Column:
    """``DATA_PATH`` filled in from a row's index."""
    before, after = DATA_PATH.split("{chunk_index}")
    return F.concat(F.lit(before), chunk_of(chunk_rows).cast("string"), F.lit(after))


def export_chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """``chunk_index, from_index, to_index, rows`` of every folder; ``to_index`` is exclusive."""
    return rows.groupBy(chunk_of(chunk_rows).alias("chunk_index")).agg(
        F.min("index").alias("from_index"), (F.max("index") + 1).alias("to_index"), F.count(F.lit(1)).alias("rows")
    )


def export_episodes(rows: DataFrame) -> DataFrame:
    """Every training row is an episode of one frame."""
    return rows.select(
        "episode_index",
        F.array(F.coalesce(col("task.instructions"), F.lit(""))).alias("tasks"),
        F.lit(1).cast("long").alias("length"),
        F.col("index").alias("dataset_from_index"),
        (F.col("index") + 1).alias("dataset_to_index"),
        "task_index",
        *_EPISODE_LINKS,
    )


def sample_refs(manifest: DataFrame, refs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested lineage and video document of every manifest row; ``keep`` adds manifest columns to it."""

    def field(name: str) -> Column:
        if name in manifest.columns:
            return F.col(name)
        kind = "long" if name in _LONGS else "double" if name in _DOUBLES else "string"
        return F.lit(None).cast(kind)

    annotation = {
        "type": "annotation_type",
        "version": "annotation_version",
        "policy": "annotation_policy",
        "language": "annotation_language",
        "task_label": "task_label",
        "object_label": "object_label",
        "scene_label": "scene_label",
        "table": "annotation_table",
        "snapshot_id": "annotation_snapshot_id",
    }
    sync = {"status": "sync_status", "rule": "sync_rule", "max_timestamp_gap_seconds": "max_timestamp_gap_seconds"}
    source = {"table": "source_frames_table", "snapshot_id": "source_frames_snapshot_id"}

    def group(fields: dict[str, str], name: str) -> Column:
        return F.struct(*[field(inner).alias(outer) for outer, inner in fields.items()]).alias(name)

    source_id = field("source_sample_id") if "source_sample_id" in manifest.columns else F.col("sample_id")
    joined = manifest.join(refs_by_episode(refs), "episode_id", "left")
    videos = F.coalesce(F.col("video_refs"), F.array())
    return joined.select(
        "sample_id",
        source_id.alias("source_sample_id"),
        "episode_id",
        "instruction_id",
        "instruction_text",
        field("source_instruction_id").alias("source_instruction_id"),
        field("source_instruction_text").alias("source_instruction_text"),
        group(annotation, "annotation"),
        group(sync, "sync"),
        group(source, "source_frames"),
        F.array("observation_start_frame", "observation_end_frame").alias("observation_frame_range"),
        F.array("action_start_frame", "action_end_frame").alias("action_frame_range"),
        videos.alias("video_refs"),
        F.size(F.filter(videos, lambda ref: ~ref["exists"])).cast("long").alias("missing_video_count"),
        *keep,
    )


def export_stats(manifest: DataFrame, refs: DataFrame) -> DataFrame:
    """One row of counters of a stored manifest. Missing videos are those of exported episodes.

    Every distinct count is of values tagged with their counter, so that one pass and one exchange serve them all.
    """

    def or_else(name: str, other: Column) -> Column:
        return F.coalesce(F.col(name).cast("string"), other) if name in manifest.columns else other

    distinct = {
        "export_total_tasks": _instruction(),
        "source_sample_count": or_else("source_sample_id", F.col("sample_id")),
        "source_episode_count": F.col("episode_id"),
    }
    tagged = F.array(*[F.struct(F.lit(name).alias("counter"), value.cast("string").alias("value")) for name, value in distinct.items()])
    values = manifest.select(F.inline(tagged)).groupBy("counter", "value").agg(F.count(F.lit(1)).alias("rows"))
    used = values.where("counter = 'source_episode_count' and value is not null").select(F.col("value").alias("episode_id"))
    missing = refs.where(~F.col("exists")).join(used, "episode_id", "left_semi")
    any_counter = next(iter(distinct))
    counts = values.agg(
        F.coalesce(F.sum(F.when(F.col("counter") == any_counter, F.col("rows"))), F.lit(0)).alias("export_total_samples"),
        *[F.count(F.when(F.col("counter") == name, F.col("value"))).alias(name) for name in distinct],
    )
    return merge_rows(counts, missing.agg(F.countDistinct("path").alias("missing_video_ref_count")))


def merge_rows(*rows: DataFrame) -> DataFrame:
    """One-row tables with different columns as a single row."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(col(n)).alias(n) for n in stacked.columns])


def missing_video_paths(manifest: DataFrame, refs: DataFrame) -> DataFrame:
    used = manifest.select("episode_id").distinct()
    return refs.where(~F.col("exists")).join(used, "episode_id", "left_semi").select("path").distinct()


def annotation_counts(manifest: DataFrame, name: str) -> DataFrame:
    """Rows per value of an annotation column; ``unknown`` when the manifest has no such column or value."""
    value = F.coalesce(F.col(name).cast("string"), F.lit("unknown")) if name in manifest.columns else F.lit("unknown")
    return manifest.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("samples"))


def feature_map(schema: T.StructType, info: dict[str, Any]) -> dict[str, Any]:
    """Feature descriptions of the export, from its schema and the source description."""
    known = info.get("features", {})

    def describe(field: T.StructField) -> dict[str, Any]:
        name, kind = field.name, field.dataType
        if name in known:
            return known[name]
        if name == "timestamp" or isinstance(kind, (T.DoubleType, T.FloatType)):
            return {"dtype": "float32", "shape": [1], "names": None}
        if name in _INDEX_NAMES or name.endswith(("_frame", "_rows", "_snapshot_id")):
            return {"dtype": "int64", "shape": [1], "names": None}
        if isinstance(kind, T.ArrayType):
            # the length of an undeclared vector is not part of a schema
            return {"dtype": "list", "shape": [None], "names": None}
        return {"dtype": "string", "shape": [1], "names": None}

    return {field.name: describe(field) for field in schema.fields}


def undeclared_lengths(rows: DataFrame, info: dict[str, Any]) -> DataFrame | None:
    """One row with the longest length of every list column the source description does not cover."""
    known = info.get("features", {})
    names = [f.name for f in rows.schema if isinstance(f.dataType, T.ArrayType) and f.name not in known]
    if not names:
        return None
    return rows.agg(*[F.max(F.size(col(n))).alias(n) for n in names])


def export_info(
    rows: DataFrame, info: dict[str, Any], totals: dict[str, Any], digest: str, chunk_rows: int = CHUNK_ROWS
) -> dict[str, Any]:
    """Description document of an export; ``totals`` is the collected row of ``export_stats``."""
    features = feature_map(rows.schema, info)
    lengths = undeclared_lengths(rows, info)
    if lengths is not None:
        for name, length in lengths.first().asDict().items():
            features[name]["shape"] = [length]
    n = totals["export_total_samples"]
    return {
        "format": EXPORT_FORMAT,
        "export_version": digest[:16],
        "manifest_sha256": digest,
        "codebase_version": info.get("codebase_version", DEFAULT_CODEBASE_VERSION),
        "robot_type": info.get("robot_type"),
        "total_episodes": n,
        "total_frames": n,
        "total_tasks": totals["export_total_tasks"],
        "fps": info.get("fps"),
        "splits": {"train": f"0:{n}"},
        "data_path": DATA_PATH,
        "chunks_size": chunk_rows,
        "total_chunks": -(-n // chunk_rows),
        "video_path": info.get("video_path"),
        "features": features,
    }


LINEAGE_FIELDS = [
    "source_frames_table", "source_frames_snapshot_id", "annotation_table", "annotation_snapshot_id",
    "annotation_version", "sync_rule",
]


def lineage_row(manifest: DataFrame) -> DataFrame:
    """The origin of an export in one row; fails when the manifest mixes origins."""

    def single(name: str) -> Column:
        if name not in manifest.columns:
            return F.lit(None).cast("long" if name in _LONGS else "string").alias(name)
        low, high = F.min(name), F.max(name)
        mixed = F.coalesce(low != high, F.lit(False)) | (
            (F.count(name) > 0) & (F.count(name) < F.count(F.lit(1)))
        )
        return F.when(mixed, F.raise_error(F.lit(f"manifest mixes values of {name}"))).otherwise(low).alias(name)

    return manifest.agg(F.count(F.lit(1)).alias("manifest_row_count"), *[single(n) for n in LINEAGE_FIELDS])
