"""The whole build: contract, ingest, sync, annotations, manifest, validation, export, export validation."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe import __version__
from strideframe.config import AnnotationConfig, FrameManifestConfig, ManifestConfig, SyncConfig, config_hash
from strideframe.functions.columns import normalize_columns
from strideframe.operators import annotations as A
from strideframe.operators import manifest as M
from strideframe.operators.export import CHUNK_ROWS
from strideframe.operators.ordering import indexed_rows
from strideframe.operators.resolve import preview_samples
from strideframe.operators.sync import status_counts, sync_summary, synced_samples
from strideframe.operators.video import video_refs
from strideframe.plans import build_checks as B
from strideframe.plans import summaries
from strideframe.plans.contract import Snapshot, contract_report, load_snapshot
from strideframe.plans.export_files import validate_export, write_export
from strideframe.sources import files, scratch
from strideframe.sources.small import literal_table
from strideframe.sources.snapshots import Commit, SnapshotStore

RAW = {"frames": "raw.frames", "episodes": "raw.episodes", "tasks": "raw.tasks"}
SYNCED = "synced.samples"
ANNOTATIONS = "annotations.instructions"
MANIFEST = "manifests.samples"
MANIFEST_FORMAT = "episode_manifest_v0"


@dataclass(frozen=True)
class BuildSettings:
    dataset_name: str
    snapshot_dir: str
    warehouse_dir: str
    registry_dir: str
    export_dir: str
    sync: SyncConfig
    annotation: AnnotationConfig
    manifest: ManifestConfig
    codec: str = "snappy"
    inspect: bool = False
    export_chunk_rows: int = CHUNK_ROWS


def _plain(config: Any) -> dict[str, Any]:
    """A config dataclass as JSON-ready dict."""
    from dataclasses import asdict

    return asdict(config)


def ingest(store: SnapshotStore, snapshot_dir: str, codec: str = "snappy") -> dict[str, Any]:
    """Raw frames, episodes and tasks as tables. Without task metadata the tasks table is written empty."""
    spark = store.spark
    raw = normalize_columns(files.read_parquet_tree(spark, f"{snapshot_dir}/data"))
    frames = store.write(RAW["frames"], raw, codec)
    episodes, episode_source = files.read_episodes(spark, snapshot_dir, store.read(RAW["frames"]))
    tasks, task_source = files.read_tasks(spark, snapshot_dir)
    if tasks is None:
        tasks = literal_table(spark, [], "task_index long, task string")
    return {
        RAW["frames"]: {"rows": frames.rows, "source": "data"},
        RAW["episodes"]: {"rows": store.write(RAW["episodes"], episodes, codec).rows, "source": episode_source},
        RAW["tasks"]: {"rows": store.write(RAW["tasks"], tasks, codec).rows, "source": task_source},
    }


def sync_step(store: SnapshotStore, s: BuildSettings) -> Commit:
    source = store.latest_id(RAW["frames"])
    samples = synced_samples(store.read(RAW["frames"]), store.read_optional(RAW["tasks"]), s.sync, source)
    commit = store.write(SYNCED, samples, s.codec)
    written = store.read(SYNCED)
    lineage = {
        "dataset_name": s.dataset_name,
        "engine_version": __version__,
        "sync_config_sha256": config_hash(_plain(s.sync)),
        "source_table": RAW["frames"],
        "source_snapshot_id": source,
        "target_table": SYNCED,
        "target_snapshot_id": commit.snapshot_id,
        **_plain(s.sync),
    }
    widest = sync_summary(written).first()["max_observed_timestamp_gap_seconds"]
    stats = {
        "synced_samples": commit.rows,
        "sync_status_counts": {r["sync_status"]: r["samples"] for r in status_counts(written).collect()},
        "max_observed_timestamp_gap_seconds": widest,
    }
    files.write_document(store.spark, f"{s.registry_dir}/sync_lineage.json", lineage)
    files.write_document(store.spark, f"{s.registry_dir}/sync_stats.json", stats)
    return commit


def annotation_step(store: SnapshotStore, s: BuildSettings) -> Commit:
    source = store.latest_id(SYNCED)
    commit = store.write(ANNOTATIONS, A.annotations(store.read(SYNCED), s.annotation), s.codec)
    written = store.read(ANNOTATIONS)
    lineage = {
        "dataset_name": s.dataset_name,
        "engine_version": __version__,
        "annotation_config_sha256": config_hash(_plain(s.annotation)),
        "source_table": SYNCED,
        "source_snapshot_id": source,
        "target_table": ANNOTATIONS,
        "target_snapshot_id": commit.snapshot_id,
        "annotation_version": s.annotation.version,
        "annotation_policy": s.annotation.policy,
        "require_sync_status": s.annotation.require_status,
    }
    stats = {
        "annotations": commit.rows,
        "annotation_type_counts": {r["annotation_type"]: r["annotations"] for r in A.type_counts(written).collect()},
        "annotations_per_episode_summary": A.per_episode_summary(written).first().asDict(),
    }
    files.write_document(store.spark, f"{s.registry_dir}/annotation_lineage.json", lineage)
    files.write_document(store.spark, f"{s.registry_dir}/annotation_stats.json", stats)
    return commit


def manifest_step(store: SnapshotStore, s: BuildSettings, info: dict[str, Any]) -> Commit:
    """The sorted manifest as a table and as JSON lines, with its registry documents."""
    source = store.latest_id(SYNCED)
    annotated = s.manifest.annotation_table is not None
    annotation_id = store.latest_id(ANNOTATIONS) if annotated else None
    if annotated:
        rows = M.annotated_manifest(store.read(SYNCED), store.read(ANNOTATIONS), s.manifest, annotation_id)
    else:
        rows = M.plain_manifest(store.read(SYNCED), s.manifest)
    origin = {
        "source_type": "synced_table",
        "snapshot_dir": s.snapshot_dir,
        "source_table": SYNCED,
        "source_snapshot_id": source,
        "annotation_table": ANNOTATIONS if annotated else None,
        "annotation_snapshot_id": annotation_id,
        "annotation_version": s.manifest.annotation_version,
        "annotation_active_only": s.manifest.annotation_active_only,
        "annotation_join_columns": list(s.manifest.join_columns),
        "require_sync_status": s.manifest.require_status,
    }
    return record_manifest(store, rows, s.dataset_name, s.registry_dir, s.codec, origin, info)


def frame_manifest_step(
    store: SnapshotStore, dataset_name: str, snapshot_dir: str, registry_dir: str, config: FrameManifestConfig, codec: str = "snappy"
) -> Commit:
    """A manifest straight from the frames of a snapshot, without synced samples or annotations, with the same documents."""
    frames = files.read_parquet_tree(store.spark, f"{snapshot_dir}/data")
    info = files.read_document(store.spark, f"{snapshot_dir}/meta/info.json")
    origin = {
        "source_type": "snapshot_frames",
        "snapshot_dir": snapshot_dir,
        "episode_filter": list(config.episodes),
        "frame_stride": config.stride,
        "window": _plain(config.window),
        "frame_manifest_config_sha256": config_hash(_plain(config)),
    }
    return record_manifest(store, M.frame_manifest(frames, config), dataset_name, registry_dir, codec, origin, info)


def record_manifest(
    store: SnapshotStore, rows: DataFrame, dataset_name: str, registry_dir: str, codec: str, origin: dict[str, Any], info: dict[str, Any]
) -> Commit:
    """Write a manifest, sorted, as a table and as JSON lines, and its ``lineage``, ``stats`` and ``metadata`` documents."""
    commit = store.write(MANIFEST, M.sort_manifest(rows), codec)
    written = store.read(MANIFEST)
    json_path = f"{store.location(MANIFEST)}/jsonl/snap-{commit.snapshot_id}"
    M.write_json_lines(written, json_path)
    digest = M.manifest_digest(written).first()
    sha, version = digest["content_sha256"], digest["content_version"]
    documents = {
        "lineage": {
            "dataset_name": dataset_name,
            "engine_version": __version__,
            "manifest_version": version,
            "manifest_sha256": sha,
            **origin,
            **{f"source_{name}": info.get(name) for name in ("codebase_version", "total_episodes", "total_frames")},
            "manifest_path": json_path,
            "manifest_parquet_path": commit.path,
            "parquet_compression": codec,
        },
        "stats": {"manifest_rows": commit.rows, "manifest_version": version, "manifest_sha256": sha},
        "metadata": {
            "dataset_name": dataset_name,
            "format": MANIFEST_FORMAT,
            "manifest_version": version,
            "manifest_path": json_path,
            "manifest_parquet_path": commit.path,
            "created_at_utc": commit.committed_at,
        },
    }
    for name, document in documents.items():
        files.write_document(store.spark, f"{registry_dir}/{name}.json", document)
    return commit


def validation_step(store: SnapshotStore, s: BuildSettings) -> dict[str, Any]:
    spark = store.spark

    def document(name: str) -> dict[str, Any]:
        return files.read_document(spark, f"{s.registry_dir}/{name}.json")

    registry = {name: document(name) for name in ("metadata", "lineage", "stats")}
    samples, synced_id = store.read(SYNCED), store.latest_id(SYNCED)
    annotations = store.read(ANNOTATIONS) if s.manifest.annotation_table is not None else None
    json_rows = M.read_json_lines(spark, registry["metadata"]["manifest_path"])
    checks = B.raw_checks(store, RAW).union(
        B.synced_checks(samples, s.manifest, synced_id, document("sync_lineage"), document("sync_stats"))
    )
    if annotations is not None:
        checks = checks.union(
            B.annotation_checks(
                annotations,
                s.manifest,
                store.latest_id(ANNOTATIONS),
                document("annotation_lineage"),
                document("annotation_stats"),
            )
        )
    checks = checks.union(
        B.manifest_checks(store.read(MANIFEST), json_rows, samples, annotations, s.manifest, synced_id, registry)
    )
    required = samples.where(F.col("sync_status") == (s.manifest.require_status or "ok")).count()
    return B.report_document(
        checks,
        validated_at_utc=datetime.now(timezone.utc).isoformat(),
        raw={key: store.read(table).count() for key, table in RAW.items()},
        synced={"rows": samples.count(), "required_status_rows": required},
        annotations=A.active_annotations(
            annotations, s.manifest.annotation_active_only, s.manifest.annotation_version
        ).count()
        if annotations is not None
        else 0,
    )


def export_step(store: SnapshotStore, s: BuildSettings, snapshot: Snapshot) -> dict[str, Any]:
    """Export from the raw snapshot, whose dotted column names the training rows keep."""
    spark = store.spark
    indexed = indexed_rows(store.read(MANIFEST), "index")
    episodes = snapshot.episodes if snapshot.episodes is not None else store.read(RAW["episodes"])
    refs = video_refs(episodes, snapshot.listing, snapshot.info)
    source_stats = files.read_document(spark, f"{s.snapshot_dir}/meta/stats.json")
    created = datetime.now(timezone.utc).isoformat()
    registry = f"{s.registry_dir}/exports"
    metadata = files.read_document(spark, f"{s.registry_dir}/metadata.json")
    return write_export(
        indexed, snapshot.frames, refs, s.export_dir, created, snapshot.info, source_stats, registry,
        {"snapshot_dir": s.snapshot_dir, "manifest_path": metadata.get("manifest_path")}, s.export_chunk_rows,
    )


def run_build(spark: SparkSession, s: BuildSettings) -> dict[str, Any]:
    """Run every step and return the summary. A failed validation raises after its report is stored.

    Intermediate tables go below one scratch folder, which is removed when the build has ended.
    """
    with scratch.removed_after(spark, "build"):
        return _run_steps(spark, s)


def _run_steps(spark: SparkSession, s: BuildSettings) -> dict[str, Any]:
    store = SnapshotStore(spark, s.warehouse_dir)
    snapshot = load_snapshot(spark, s.snapshot_dir)
    contract = contract_report(snapshot, f"{s.registry_dir}/contract_offenders")
    files.write_document(spark, f"{s.registry_dir}/contract_report.json", contract)
    _stop_if_failed("contract", contract)
    inspected: dict[str, Any] = {}
    ingest(store, s.snapshot_dir, s.codec)
    sync_step(store, s)
    annotation_step(store, s)
    manifest = manifest_step(store, s, snapshot.info)
    report = validation_step(store, s)
    files.write_document(spark, f"{s.registry_dir}/validation_report.json", report)
    _stop_if_failed("build validation", report)
    if s.inspect:
        inspected = inspect_tables(store, snapshot)
    export = export_step(store, s, snapshot)
    checked = validate_export(spark, export["export_dir"], store.read(MANIFEST), f"{s.registry_dir}/exports")
    _stop_if_failed("export validation", checked)
    version = files.read_document(spark, f"{s.registry_dir}/stats.json")["manifest_version"]
    summary = build_summary(report, checked, export, manifest, version)
    files.write_document(spark, f"{s.registry_dir}/build_summary.json", summary)
    return {**summary, **({"inspect": inspected} if inspected else {})}


def _stop_if_failed(step: str, report: dict[str, Any]) -> None:
    if report["status"] != "passed":
        failed = [row["name"] for row in report.get("checks", []) if row["status"] == "error"]
        raise RuntimeError(f"{step} failed: {failed or report.get('missing_files')}")


def inspect_tables(store: SnapshotStore, snapshot: Snapshot) -> dict[str, Any]:
    first = store.read(MANIFEST).orderBy(*M.manifest_order(store.read(MANIFEST))).limit(1)
    resolved: DataFrame = preview_samples(first, snapshot.frames)
    return {
        "snapshot": summaries.snapshot_summary(store.spark, snapshot.path),
        "raw": {name: summaries.table_summary(store, name) for name in RAW.values()},
        "synced": summaries.synced_summary(store, SYNCED, 3),
        "annotations": summaries.annotation_summary(store, ANNOTATIONS, 6),
        "resolved": [row.asDict(recursive=True) for row in resolved.collect()],
    }


def build_summary(
    report: dict[str, Any], checked: dict[str, Any], export: dict[str, Any], manifest: Commit, manifest_version: str
) -> dict[str, Any]:
    """``manifest_version`` is that of the manifest as built, so an export of another manifest shows."""
    return {
        "dataset_build_status": report["status"],
        "export_status": checked["status"],
        "raw_frames": report["raw"]["frames"],
        "raw_episodes": report["raw"]["episodes"],
        "synced_samples": report["synced"]["rows"],
        "synced_ok_samples": report["synced"]["required_status_rows"],
        "annotations": report["annotations"],
        "manifest_rows": manifest.rows,
        "export_rows": export["export_total_samples"],
        "source_samples": export["source_sample_count"],
        "source_episodes": export["source_episode_count"],
        "missing_video_refs": export["missing_video_ref_count"],
        "manifest_version": manifest_version,
        "export_version": export["export_version"],
        "export_dir": export["export_dir"],
    }
