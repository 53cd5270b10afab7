"""Writing an export, and checking one that was written."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.operators import checks as C
from strideframe.operators import export as X
from strideframe.operators.manifest import manifest_digest
from strideframe.operators.ordering import sort_placed
from strideframe.sources import files, scratch
from strideframe.sources.small import literal_table

LOG_SCHEMA = "export_version string, committed_at string, path string"
# columns every data row must have
REQUIRED_DATA_COLUMNS = [
    "annotation_version", "action_end_frame", "action_start_frame", "instruction_id", "observation_end_frame",
    "observation_start_frame", "sample_id", "source_episode_id", "source_frames_snapshot_id", "source_sample_id",
    "sync_status", "task.instructions",
]
LAYOUT = {
    "data": "data",
    "episodes": "meta/episodes",
    "tasks": "meta/tasks",
    "refs": "meta/sample_refs",
    "info": "meta/info.json",
    "stats": "meta/stats.json",
    "lineage": "meta/export_lineage.json",
}
CHUNKS = "meta/chunks"  # the index range of every data folder


def write_export(
    indexed: DataFrame,
    frames: DataFrame,
    refs: DataFrame,
    export_dir: str,
    created_at_utc: str,
    info: dict[str, Any] | None = None,
    source_stats: dict[str, Any] | None = None,
    registry_dir: str | None = None,
    origin: dict[str, str] | None = None,
    chunk_rows: int = X.CHUNK_ROWS,
) -> dict[str, Any]:
    """Write all parts below a fresh folder of ``export_dir`` and commit it there as the last step.

    ``indexed`` is a manifest with its ``index``; ``origin`` names where it came from (``snapshot_dir``, ``manifest_path``). An earlier export stays readable until, and after, the commit.
    Data rows lie in numbered folders of ``chunk_rows`` rows, so the folder of a row follows from its index.
    """
    spark = indexed.sparkSession
    info = info or {}
    manifest = indexed.drop("index")
    digest = manifest_digest(manifest).first()
    if digest["rows"] == 0:
        raise ValueError("the manifest is empty")
    version, sha = digest["content_version"], digest["content_sha256"]
    path = f"{export_dir.rstrip('/')}/{version}-{uuid.uuid4().hex[:8]}"
    place = {part: f"{path}/{name}" for part, name in LAYOUT.items()}

    # every part is in index order: an episode names the rows it holds by position
    X.export_tasks(indexed).orderBy("task_index").write.parquet(place["tasks"])
    tasks = spark.read.parquet(place["tasks"])
    chunked = X.export_rows(indexed, tasks, frames).withColumn("chunk_index", X.chunk_of(chunk_rows))
    # the side tables come from the copy that is sorted, not from the data folders: these may be very many small files
    stored = scratch.store(chunked, "unsorted")
    sort_placed(stored, ["chunk_index", "index"]).write.partitionBy("chunk_index").parquet(place["data"])
    rows = stored.drop("chunk_index")
    X.export_chunks(rows, chunk_rows).orderBy("chunk_index").write.parquet(f"{path}/{CHUNKS}")
    X.export_episodes(rows).orderBy("episode_index").write.parquet(place["episodes"])
    X.sample_refs(indexed, refs, keep=["index"]).orderBy("index").drop("index").write.json(place["refs"])

    totals = X.export_stats(manifest, refs).first().asDict()
    missing = X.missing_video_paths(manifest, refs)
    missing.write.json(f"{path}/meta/missing_videos")
    documents = {
        "info": X.export_info(rows, info, totals, sha, chunk_rows),
        "stats": {
            **totals,
            **{
                f"{name}_counts": {r[name]: r["samples"] for r in X.annotation_counts(manifest, name).orderBy(name).collect()}
                for name in ("annotation_type", "annotation_version")
            },
            "missing_video_paths": "meta/missing_videos",
            "source_stats": source_stats or {},
        },
        "lineage": {
            "format": X.EXPORT_FORMAT,
            "export_version": version,
            **{name: (origin or {}).get(name) for name in ("snapshot_dir", "manifest_path")},
            "manifest_sha256": sha,
            "created_at_utc": created_at_utc,
            **X.lineage_row(manifest).first().asDict(),
            "export_dir": path,
            **{f"{part}_path": name for part, name in LAYOUT.items()},
            "chunks_path": CHUNKS,
        },
    }
    for part, document in documents.items():
        files.write_document(spark, place[part], document)
    if registry_dir:
        for name, part in (("metadata", "info"), ("stats", "stats"), ("lineage", "lineage")):
            files.write_document(spark, f"{registry_dir}/{name}.json", documents[part])
    entry = literal_table(spark, [(version, created_at_utc, path)], LOG_SCHEMA)
    entry.write.mode("append").json(f"{export_dir.rstrip('/')}/log")
    return {"export_version": version, "export_dir": path, "samples": totals["export_total_samples"], **totals}


def current_export(spark: SparkSession, export_dir: str) -> str:
    log = files.read_json_lines(spark, f"{export_dir.rstrip('/')}/log", LOG_SCHEMA)
    return log.orderBy(F.desc("committed_at"), F.desc("path")).first()["path"]


def export_checks(
    manifest: DataFrame,
    data: DataFrame,
    episodes: DataFrame,
    refs: DataFrame,
    documents: dict[str, dict[str, Any]],
    registry: dict[str, dict[str, Any]] | None = None,
) -> DataFrame:
    """The content checks of an export; with a registry also that its documents exist and agree."""
    info, stats, lineage = (documents.get(k, {}) for k in ("info", "stats", "lineage"))
    absent = [n for n in REQUIRED_DATA_COLUMNS if n not in data.columns]
    unique = C.duplicate_rows(["sample_id"]) if "sample_id" in data.columns else F.lit(None).cast("long")
    digest = manifest_digest(manifest).select(F.col("rows").alias("manifest_rows"), "content_sha256")
    metrics = X.merge_rows(
        digest,
        data.agg(F.count(F.lit(1)).alias("data_rows"), unique.alias("duplicates")),
        episodes.agg(F.count(F.lit(1)).alias("episode_rows")),
        refs.agg(F.count(F.lit(1)).alias("ref_rows"), C.duplicate_rows(["sample_id"]).alias("ref_duplicates")),
    )
    rows, sha = F.col("data_rows"), F.col("content_sha256")

    def known(document: dict[str, Any], key: str, kind: str):
        return F.lit(document.get(key)).cast(kind)

    conditions = {
        "manifest_rows_match_data_rows": F.col("manifest_rows") == rows,
        "episode_rows_match_data_rows": F.col("episode_rows") == rows,
        "sample_refs_match_data_rows": F.col("ref_rows") == rows,
        "info_total_frames_match_data_rows": known(info, "total_frames", "long") == rows,
        "stats_total_samples_match_data_rows": known(stats, "export_total_samples", "long") == rows,
        "lineage_manifest_rows_match": known(lineage, "manifest_row_count", "long") == F.col("manifest_rows"),
        "lineage_manifest_sha256_match": known(lineage, "manifest_sha256", "string") == sha,
        "info_manifest_sha256_match": known(info, "manifest_sha256", "string") == sha,
        "sample_ids_are_unique": F.col("duplicates") == 0,
        "sample_refs_are_unique": F.col("ref_duplicates") == 0,
        "required_columns_present": F.lit(not absent),
    }
    if registry is not None:
        for name in ("metadata", "stats", "lineage"):
            conditions[f"registry_{name}_exists"] = F.lit(bool(registry.get(name)))
        if registry.get("lineage"):
            conditions["registry_lineage_sha256_match"] = known(registry["lineage"], "manifest_sha256", "string") == sha
    details = {n: F.col(n) for n in ("manifest_rows", "data_rows", "episode_rows", "ref_rows")}
    details["missing_columns"] = F.lit(",".join(absent))
    return C.check_rows(metrics, [C.check("export", name, ok, details) for name, ok in conditions.items()])


def validate_export(
    spark: SparkSession, path: str, manifest: DataFrame, registry_dir: str | None = None
) -> dict[str, Any]:
    """Report on the export at ``path``; it stops early when a part is missing."""
    parts: dict[str, Any] = {}
    missing = []
    for part, name in LAYOUT.items():
        try:
            if part in ("info", "stats", "lineage"):
                parts[part] = files.read_document(spark, f"{path}/{name}")
                if not parts[part]:
                    missing.append(name)
            elif part == "refs":
                parts[part] = files.read_json_lines(spark, f"{path}/{name}")
            else:
                parts[part] = files.read_parquet_tree(spark, f"{path}/{name}")
        except FileNotFoundError:
            missing.append(name)
    if missing:
        return {"status": "failed", "missing_files": missing}
    registry = None
    if registry_dir:
        names = ("metadata", "stats", "lineage")
        registry = {n: files.read_document(spark, f"{registry_dir}/{n}.json") for n in names}
    checks = export_checks(manifest, parts["data"], parts["episodes"], parts["refs"], parts, registry)
    rows = [row.asDict() for row in checks.collect()]
    failed = [row["name"] for row in rows if row["status"] != "ok"]
    report = {
        "status": "failed" if failed else "passed",
        "export_dir": path,
        "export_version": parts["info"].get("export_version"),
        "task_rows": parts["tasks"].count(),
        "missing_video_ref_count": parts["stats"].get("missing_video_ref_count"),
        "checks": rows,
    }
    files.write_document(spark, f"{path}/meta/validation_report.json", report)
    if registry_dir:
        files.write_document(spark, f"{registry_dir}/validation_report.json", report)
    return report
