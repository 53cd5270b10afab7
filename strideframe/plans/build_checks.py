"""Build validation: raw, synced, annotation and manifest tables against each other and their registry documents."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.config import ManifestConfig
from strideframe.operators import checks as C
from strideframe.operators.annotations import active_annotations
from strideframe.operators.export import merge_rows
from strideframe.operators.manifest import expected_rows, manifest_digest
from strideframe.sources.small import one_row
from strideframe.sources.snapshots import SnapshotStore


def _long(value: int | None) -> Column:
    return F.lit(value).cast("long")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def raw_checks(store: SnapshotStore, tables: dict[str, str]) -> DataFrame:
    """``tables``: frames / episodes / tasks -> table name."""
    rows = []
    for key, name in tables.items():
        commit = store.latest(name)
        count = store.read(name).count() if commit else 0
        snapshot_id = commit.snapshot_id if commit else None
        details = {"table": F.lit(name), "rows": _long(count), "snapshot_id": _long(snapshot_id)}
        rows.append(C.check("raw", f"raw_{key}_table_not_empty", F.lit(count > 0), details))
        rows.append(C.check("raw", f"raw_{key}_snapshot_exists", F.lit(commit is not None), details))
    return C.check_rows(one_row(store.spark), rows)


def synced_checks(
    samples: DataFrame, config: ManifestConfig, snapshot_id: int | None, lineage: dict[str, Any], stats: dict[str, Any]
) -> DataFrame:
    status = config.require_status or "ok"
    kept = F.coalesce(F.col("sync_status") == status, F.lit(False))
    flags = [n for n in C.QUALITY_FLAGS if n in samples.columns]
    required = [n for n in C.SYNCED_REQUIRED if n in samples.columns]
    metrics = samples.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(kept).alias("kept"),
        C.duplicate_rows(["sample_id"], kept).alias("duplicates"),
        C.null_rows(required, kept).alias("nulls"),
        C.failed_flags(flags, kept).alias("failed"),
    )
    rows, suite = F.col("rows"), "synced"
    return C.check_rows(
        metrics,
        [
            C.check(suite, "synced_table_not_empty", rows > 0, {"rows": rows}),
            C.check(suite, "synced_table_snapshot_exists", F.lit(snapshot_id is not None), {"snapshot_id": _long(snapshot_id)}),
            C.check(suite, "synced_required_status_exists", F.col("kept") > 0, {"required_status": F.lit(status), "rows": F.col("kept")}),
            C.check(
                suite, "synced_non_required_rows_excluded_from_manifest", F.lit(True),
                {"non_required_rows": rows - F.col("kept")}, level="warning",
            ),
            C.check(suite, "synced_sample_id_unique", F.col("duplicates") == 0, {"duplicate_samples": F.col("duplicates")}),
            C.check(suite, "synced_required_fields_present", F.col("nulls") == 0, {"missing_required_rows": F.col("nulls")}),
            C.check(suite, "synced_quality_flags_pass", F.col("failed") == 0, {"failed_quality_flag_count": F.col("failed")}),
            C.check(
                suite, "sync_lineage_snapshot_matches_table", same(_long(lineage.get("target_snapshot_id")), _long(snapshot_id)),
                {"lineage_target_snapshot_id": _long(lineage.get("target_snapshot_id"))},
            ),
            C.check(
                suite, "sync_stats_count_matches_table", same(_long(stats.get("synced_samples")), rows),
                {"stats_synced_samples": _long(stats.get("synced_samples")), "actual_rows": rows},
            ),
        ],
    )


def annotation_checks(
    table: DataFrame,
    config: ManifestConfig,
    snapshot_id: int | None,
    lineage: dict[str, Any] | None = None,
    stats: dict[str, Any] | None = None,
) -> DataFrame:
    """Registry checks pass when there is no registry (``None``). The count is compared with all rows of the table,
    which is what the statistics count."""
    active = active_annotations(table, config.annotation_active_only, config.annotation_version)
    metrics = merge_rows(
        active.agg(F.count(F.lit(1)).alias("rows"), C.null_rows(C.ANNOTATION_REQUIRED).alias("nulls")),
        table.agg(F.count(F.lit(1)).alias("all_rows")),
        C.duplicate_groups(active, ["episode_id", "instruction_id"]),
    )
    recorded = None if lineage is None else lineage.get("target_snapshot_id")
    counted = None if stats is None else stats.get("annotations")
    suite = "annotation"
    return C.check_rows(
        metrics,
        [
            C.check(suite, "annotation_table_not_empty", F.col("rows") > 0, {"rows": F.col("rows")}),
            C.check(suite, "annotation_table_snapshot_exists", F.lit(snapshot_id is not None), {"snapshot_id": _long(snapshot_id)}),
            C.check(
                suite, "annotation_episode_instruction_unique", F.col("duplicate_groups") == 0,
                {"duplicate_annotations": F.col("duplicate_groups")},
            ),
            C.check(suite, "annotation_required_fields_present", F.col("nulls") == 0, {"missing_required_rows": F.col("nulls")}),
            C.check(
                suite, "annotation_lineage_snapshot_matches_table",
                F.lit(lineage is None) | same(_long(recorded), _long(snapshot_id)),
                {"lineage_target_snapshot_id": _long(recorded)},
            ),
            C.check(
                suite, "annotation_stats_count_matches_table", F.lit(stats is None) | same(_long(counted), F.col("all_rows")),
                {"stats_annotations": _long(counted), "actual_rows": F.col("all_rows")},
            ),
        ],
    )


def manifest_checks(
    manifest: DataFrame,
    json_rows: DataFrame,
    samples: DataFrame,
    annotations: DataFrame | None,
    config: ManifestConfig,
    synced_snapshot_id: int | None,
    registry: dict[str, dict[str, Any]],
) -> DataFrame:
    """``registry`` holds the documents ``metadata``, ``lineage`` and ``stats``; ``json_rows`` is the JSON-lines form."""
    metadata, lineage, stats = (registry.get(k, {}) for k in ("metadata", "lineage", "stats"))
    annotated = annotations is not None
    required = C.MANIFEST_REQUIRED + (C.MANIFEST_ANNOTATION_REQUIRED if annotated else [])
    snapshot = F.col("annotation_snapshot_id") if annotated else F.lit(None).cast("long")
    metrics = merge_rows(
        manifest.agg(
            F.count(F.lit(1)).alias("rows"),
            C.duplicate_rows(["sample_id"]).alias("duplicates"),
            C.null_rows(required).alias("nulls"),
            C.invalid_windows().alias("invalid"),
            F.min(snapshot).alias("low"),
            F.max(snapshot).alias("high"),
        ),
        json_rows.agg(F.count(F.lit(1)).alias("json_rows")),
        expected_rows(samples, annotations, config),
        manifest_digest(manifest).select("content_sha256", "content_version"),
    )
    rows, digest, suite = F.col("rows"), F.col("content_sha256"), "manifest"
    recorded = {
        "stats": F.lit(stats.get("manifest_sha256")),
        "lineage": F.lit(lineage.get("manifest_sha256")),
        "metadata": F.lit(metadata.get("manifest_version")),
    }
    hashes = (
        same(recorded["stats"].cast("string"), digest)
        & same(recorded["lineage"].cast("string"), digest)
        & same(recorded["metadata"].cast("string"), F.col("content_version"))
    )
    checks = [
        C.check(suite, "manifest_parquet_not_empty", rows > 0, {"rows": rows}),
        C.check(suite, "manifest_jsonl_count_matches_parquet", F.col("json_rows") == rows, {"jsonl_rows": F.col("json_rows"), "parquet_rows": rows}),
        C.check(suite, "manifest_count_matches_source_view", F.col("expected_rows") == rows, {"manifest_rows": rows, "expected_manifest_rows": F.col("expected_rows")}),
        C.check(suite, "manifest_sample_id_unique", F.col("duplicates") == 0, {"duplicate_samples": F.col("duplicates")}),
        C.check(suite, "manifest_required_fields_present", F.col("nulls") == 0, {"missing_required_rows": F.col("nulls")}),
        C.check(suite, "manifest_windows_valid", F.col("invalid") == 0, {"invalid_windows": F.col("invalid")}),
        C.check(suite, "manifest_hash_matches_registry", hashes, {"manifest_sha256": digest, **recorded}),
        C.check(
            suite, "manifest_source_snapshot_matches_synced_table",
            same(_long(lineage.get("source_snapshot_id")), _long(synced_snapshot_id)),
            {"lineage_source_snapshot_id": _long(lineage.get("source_snapshot_id")), "synced_table_snapshot_id": _long(synced_snapshot_id)},
        ),
    ]
    if annotated:
        known = _long(lineage.get("annotation_snapshot_id"))
        checks.append(
            C.check(
                suite, "manifest_annotation_snapshot_matches_lineage",
                (F.col("low") == F.col("high")) & (F.col("low") == known),
                {"lineage_annotation_snapshot_id": known, "lowest": F.col("low"), "highest": F.col("high")},
            )
        )
    return C.check_rows(metrics, checks)


def report_document(check_rows: DataFrame, **summary: Any) -> dict[str, Any]:
    """Check rows (a few dozen) and their totals as a document."""
    rows = [row.asDict() for row in check_rows.collect()]
    errors = sum(row["status"] == "error" for row in rows)
    return {
        "status": "failed" if errors else "passed",
        "error_count": errors,
        "warning_count": sum(row["status"] == "warning" for row in rows),
        **summary,
        "checks": rows,
    }
