"""The whole build on a small snapshot, and one injected fault for every check."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strideframe.config import AnnotationConfig, AnnotationRule, FrameColumns, ManifestConfig, SyncConfig
from strideframe.operators import checks as C
from strideframe.operators import export as E
from strideframe.operators import manifest as M
from strideframe.operators.ordering import indexed_rows
from strideframe.plans import build as B
from strideframe.plans import build_checks as K
from strideframe.plans.contract import Snapshot, contract_checks, contract_report, load_snapshot
from strideframe.plans.export_files import current_export, export_checks, validate_export, write_export
from strideframe.sources import files
from strideframe.sources.snapshots import SnapshotStore

EPISODES, LENGTH = 12, 100
TEMPLATE = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"
FEATURES = {
    "observation.state": {"dtype": "float32", "shape": [2]},
    "action": {"dtype": "float32", "shape": [1]},
    "observation.images.front": {"dtype": "video", "shape": [3, 2, 2]},
}


def write_snapshot(spark, root):
    frames = spark.range(EPISODES * LENGTH).select(
        F.floor(F.col("id") / LENGTH).alias("episode_index"),
        (F.col("id") % LENGTH).alias("frame_index"),
        ((F.col("id") % LENGTH) / 10.0).alias("timestamp"),
        (F.floor(F.col("id") / LENGTH) % 2).alias("task_index"),
        F.array(F.col("id") * 1.0, F.lit(0.5)).alias("observation.state"),
        F.array(F.col("id") * 2.0).alias("action"),
    )
    frames.repartition(3).write.parquet(f"{root}/data/chunk-000")
    (root / "meta").mkdir()
    info = {
        "codebase_version": "v2.1", "robot_type": "arm", "total_episodes": EPISODES, "total_frames": EPISODES * LENGTH,
        "total_tasks": 2, "fps": 10, "video_path": TEMPLATE, "chunks_size": 1000, "features": FEATURES,
    }
    (root / "meta" / "info.json").write_text(json.dumps(info))
    (root / "meta" / "stats.json").write_text('{"action": {"max": [1.0]}}')
    lines = [{"episode_index": e, "length": LENGTH} for e in range(EPISODES)]
    (root / "meta" / "episodes.jsonl").write_text("\n".join(json.dumps(x) for x in lines) + "\n")
    tasks = [{"task_index": 0, "task": "Pick."}, {"task_index": 1, "task": "Place."}]
    (root / "meta" / "tasks.jsonl").write_text("\n".join(json.dumps(x) for x in tasks) + "\n")
    for e in range(EPISODES):
        path = root / TEMPLATE.format(episode_chunk=0, video_key="observation.images.front", episode_index=e)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"v")


def settings(base, **changes):
    rules = (AnnotationRule("Pick.", ("Grab.", "Take."), object_label="o", scene_label="s", task_label="t"),)
    values = dict(
        dataset_name="small",
        snapshot_dir=str(base / "snapshot"),
        warehouse_dir=str(base / "warehouse"),
        registry_dir=str(base / "registry"),
        export_dir=str(base / "export"),
        sync=SyncConfig(columns=FrameColumns(instruction="task_instructions")),
        annotation=AnnotationConfig(
            version="v1", policy="p", created_at_utc="now", task_label="t", object_label="o", scene_label="s",
            rules=rules, require_status="ok",
        ),
        manifest=ManifestConfig(annotation_version="v1", join_columns=("episode_id", "source_instruction_id")),
        inspect=True,
    )
    return B.BuildSettings(**{**values, **changes})


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("build")
    write_snapshot(spark, base / "snapshot")
    summary = B.run_build(spark, settings(base))
    return base, summary, SnapshotStore(spark, str(base / "warehouse"))


def test_build_totals(spark, built):
    base, summary, store = built
    # anchors 30, 60, 90; the last one lacks one action frame
    assert summary["raw_frames"] == EPISODES * LENGTH and summary["raw_episodes"] == EPISODES
    assert (summary["synced_samples"], summary["synced_ok_samples"]) == (36, 24)
    assert summary["annotations"] == 6 * 3 + 6
    assert summary["manifest_rows"] == summary["export_rows"] == 6 * 2 * 3 + 6 * 2
    assert (summary["source_samples"], summary["source_episodes"], summary["missing_video_refs"]) == (24, 12, 0)
    assert summary["dataset_build_status"] == summary["export_status"] == "passed"
    assert summary["inspect"]["synced"]["sync_status_counts"] == {"ok": 24, "missing_window_rows": 12}
    assert summary["inspect"]["resolved"][0]["observation"]["rows"] == 11
    for name in ("contract_report", "sync_lineage", "sync_stats", "annotation_lineage", "annotation_stats", "lineage",
                 "stats", "metadata", "validation_report", "build_summary", "exports/lineage", "exports/validation_report"):
        assert files.read_document(spark, f"{base}/registry/{name}.json"), name


def test_export_content(spark, built):
    base, summary, _ = built
    path = current_export(spark, str(base / "export"))
    assert path == summary["export_dir"]
    rows = spark.read.parquet(f"{path}/data").orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(48))
    for r in rows:
        first = int(r["source_episode_id"]) * LENGTH + r["source_anchor_frame"]
        assert r["observation.state"][0] == first and r["action"] == [(first + 1) * 2.0]
    assert [r["source_episode_id"] for r in rows[:7]][::6] == ["0", "1"] and rows[8]["source_episode_id"] == "10"
    stored = indexed_rows(spark.read.parquet(f"{path}/data").select("index"), "position").collect()
    assert len(stored) == 48 and all(r["index"] == r["position"] for r in stored)
    refs = files.read_json_lines(spark, f"{path}/meta/sample_refs")
    assert refs.count() == 48 and {r["missing_video_count"] for r in refs.collect()} == {0}
    info = files.read_document(spark, f"{path}/meta/info.json")
    assert (info["total_frames"], info["total_tasks"], info["fps"]) == (48, 4, 10)
    assert info["features"]["observation.state"] == FEATURES["observation.state"]
    stats = files.read_document(spark, f"{path}/meta/stats.json")
    assert stats["annotation_type_counts"] == {"paraphrase": 24, "source_task": 24}
    assert stats["source_stats"] == {"action": {"max": [1.0]}}


def test_export_rows_lie_in_the_folder_of_their_index(spark, built, tmp_path):
    base, summary, store = built
    place = tmp_path / "chunked"
    manifest = indexed_rows(store.read(B.MANIFEST), "index")
    frames = files.read_parquet_tree(spark, f"{base}/snapshot/data")
    refs = spark.createDataFrame([], "episode_id string, position int, video_key string, path string, exists boolean")
    done = write_export(manifest, frames, refs, str(place), "2026-01-01T00:00:00+00:00", chunk_rows=10)
    path = done["export_dir"]
    info = files.read_document(spark, f"{path}/meta/info.json")
    assert (info["chunks_size"], info["total_chunks"]) == (10, 5)
    chunks = [tuple(r) for r in spark.read.parquet(f"{path}/meta/chunks").orderBy("chunk_index").collect()]
    assert chunks == [(n, 10 * n, min(10 * n + 10, 48), min(10, 48 - 10 * n)) for n in range(5)]
    for index in (0, 9, 10, 47):
        folder = f"{path}/" + info["data_path"].format(chunk_index=index // info["chunks_size"])
        rows = spark.read.parquet(folder)
        assert rows.where(F.col("index") == index).count() == 1 and "chunk_index" not in rows.columns
    stored = indexed_rows(spark.read.parquet(f"{path}/data").select("index"), "position").collect()
    assert len(stored) == 48 and all(r["index"] == r["position"] for r in stored)
    report = validate_export(spark, path, store.read(B.MANIFEST))
    assert report["status"] == "passed"


def test_manifest_files_agree(spark, built):
    base, _, store = built
    metadata = files.read_document(spark, f"{base}/registry/metadata.json")
    text = spark.read.text(metadata["manifest_path"])
    assert text.count() == 48 and text.where(F.col("value").contains("null")).count() == 0
    ordered = [tuple(r) for r in indexed_rows(store.read(B.MANIFEST)).orderBy("index").select("episode_id", "anchor_frame", "instruction_id").collect()]
    assert ordered == sorted(ordered)


def test_rebuild_keeps_the_manifest_version(spark, built, tmp_path):
    base, summary, store = built
    again = B.manifest_step(store, settings(base, registry_dir=str(tmp_path / "other")), {})
    digest = M.manifest_digest(store.spark.read.parquet(again.path)).first()
    assert digest["content_version"] == summary["manifest_version"]
    assert store.log(B.MANIFEST).count() >= 2


def test_export_without_annotations(spark, built, tmp_path):
    base, _, _ = built
    plain = settings(
        base, registry_dir=str(tmp_path / "r"), export_dir=str(tmp_path / "e"), manifest=ManifestConfig(annotation_table=None),
    )
    store = SnapshotStore(spark, str(tmp_path / "w"))
    store.write(B.SYNCED, built[2].read(B.SYNCED))
    assert B.manifest_step(store, plain, {}).rows == 24
    export = B.export_step(store, plain, load_snapshot(spark, str(base / "snapshot")))
    assert (export["samples"], export["export_total_tasks"]) == (24, 2)
    assert validate_export(spark, export["export_dir"], store.read(B.MANIFEST))["status"] == "passed"


def test_ingest_without_tasks_writes_an_empty_table(spark, built, tmp_path):
    base, _, _ = built
    frames = files.read_parquet_tree(spark, f"{base}/snapshot/data")
    frames.write.parquet(f"{tmp_path}/snap/data")
    store = SnapshotStore(spark, str(tmp_path / "w"))
    report = B.ingest(store, f"{tmp_path}/snap")
    assert report["raw.tasks"] == {"rows": 0, "source": None}
    assert report["raw.episodes"] == {"rows": EPISODES, "source": "derived_from_frames"}


# --- contract faults ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def snapshot(spark, built):
    return load_snapshot(spark, str(built[0] / "snapshot"))


def failing(df):
    return {r["name"] for r in df.collect() if r["status"] != "ok"}


def changed(snapshot, **changes):
    return Snapshot(**{**vars(snapshot), **changes})


def test_contract_passes(snapshot):
    report = contract_report(snapshot)
    assert report["status"] == "passed" and len(report["checks"]) == 17
    assert report["summary"]["declared_frames"] == EPISODES * LENGTH


def test_contract_of_nothing(spark, tmp_path):
    names = failing(contract_checks(load_snapshot(spark, str(tmp_path / "none"))))
    assert names == {
        "snapshot_dir_exists", "info_json_exists", "frame_parquet_exists", "episode_metadata_exists", "task_metadata_exists",
        "required_frame_columns_present", "action_column_exists", "observation_column_exists", "video_path_template_exists",
        "video_refs_resolvable", "frame_quality_checks_runnable",
    }


def _frames(snapshot, change):
    return changed(snapshot, frames=change(snapshot.frames))


FAULTS = {
    "timestamp": (
        lambda s: _frames(s, lambda f: f.withColumn("timestamp", F.when(F.expr("frame_index = 50 and episode_index = 3"), -1.0).otherwise(F.col("timestamp")))),
        {"timestamp_monotonic_by_episode"},
    ),
    "timestamp at a cell border": (
        lambda s: _frames(s, lambda f: f.withColumn("frame_index", F.col("frame_index") + 4046).withColumn("timestamp", F.when(F.expr("frame_index = 4096 and episode_index = 3"), -1.0).otherwise(F.col("timestamp")))),
        {"timestamp_monotonic_by_episode"},
    ),
    "duplicate": (
        lambda s: _frames(s, lambda f: f.union(f.where("episode_index = 2 and frame_index = 5"))),
        {"frame_index_unique_by_episode", "frame_index_contiguous_by_episode", "episode_lengths_match_frames"},
    ),
    "hole": (
        lambda s: _frames(s, lambda f: f.where("not (episode_index = 2 and frame_index = 5)")),
        {"frame_index_contiguous_by_episode", "episode_lengths_match_frames"},
    ),
    "task": (lambda s: changed(s, tasks=s.tasks.where("task_index = 0")), {"task_metadata_covers_frame_tasks"}),
    "shape": (
        lambda s: _frames(s, lambda f: f.withColumn("action", F.when(F.col("frame_index") == 5, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.col("action")))),
        {"action_observation_shapes_match_info"},
    ),
    "scalar": (lambda s: _frames(s, lambda f: f.withColumn("action", F.lit(1.0))), {"action_observation_shapes_match_info"}),
    "video": (lambda s: changed(s, listing=s.listing.where(~F.col("path").endswith("000003.mp4"))), {"video_refs_resolvable"}),
    "no action": (lambda s: _frames(s, lambda f: f.drop("action")), {"action_column_exists"}),
    "no template": (
        lambda s: changed(s, info={**s.info, "video_path": None}), {"video_path_template_exists", "video_refs_resolvable"},
    ),
    "no timestamp": (
        lambda s: _frames(s, lambda f: f.drop("timestamp")),
        {"required_frame_columns_present", "frame_quality_checks_runnable"},
    ),
}


@pytest.mark.parametrize("fault", sorted(FAULTS))
def test_contract_faults(snapshot, fault):
    change, names = FAULTS[fault]
    assert failing(contract_checks(change(snapshot))) == names


def test_build_stops_at_a_broken_contract(spark, built, tmp_path):
    base, _, _ = built
    with pytest.raises(RuntimeError, match="contract failed"):
        B.run_build(spark, settings(base, snapshot_dir=str(tmp_path), registry_dir=str(tmp_path / "r")))
    assert files.read_document(spark, f"{tmp_path}/r/contract_report.json")["status"] == "failed"


# --- build faults --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def parts(spark, built):
    base, _, store = built
    document = {n: files.read_document(spark, f"{base}/registry/{n}.json") for n in (
        "sync_lineage", "sync_stats", "annotation_lineage", "annotation_stats", "lineage", "stats", "metadata")}
    return {
        "document": document,
        "samples": store.read(B.SYNCED),
        "annotations": store.read(B.ANNOTATIONS),
        "manifest": spark.read.parquet(document["metadata"]["manifest_parquet_path"]),
        "synced_id": store.latest_id(B.SYNCED),
        "annotation_id": store.latest_id(B.ANNOTATIONS),
        "config": settings(base).manifest,
    }


def synced(p, samples=None, snapshot_id=0, lineage=None, stats=None):
    return failing(
        K.synced_checks(
            p["samples"] if samples is None else samples,
            p["config"],
            p["synced_id"] if snapshot_id == 0 else snapshot_id,
            p["document"]["sync_lineage"] if lineage is None else lineage,
            p["document"]["sync_stats"] if stats is None else stats,
        )
    )


def test_raw_faults(spark, built, tmp_path):
    assert failing(K.raw_checks(built[2], B.RAW)) == set()
    store = SnapshotStore(spark, str(tmp_path))
    store.write("raw.tasks", spark.range(0))
    assert failing(K.raw_checks(store, {"tasks": "raw.tasks", "frames": "raw.frames"})) == {
        "raw_tasks_table_not_empty", "raw_frames_table_not_empty", "raw_frames_snapshot_exists",
    }


def test_synced_faults(parts):
    s = parts["samples"]
    assert synced(parts) == set()
    assert synced(parts, s.limit(0)) == {"synced_table_not_empty", "synced_required_status_exists", "sync_stats_count_matches_table"}
    assert synced(parts, snapshot_id=None) == {"synced_table_snapshot_exists", "sync_lineage_snapshot_matches_table"}
    assert synced(parts, s.withColumn("sync_status", F.lit("bad"))) == {"synced_required_status_exists"}
    one = s.where("sync_status = 'ok'").limit(1)
    assert synced(parts, s.union(one)) == {"synced_sample_id_unique", "sync_stats_count_matches_table"}
    assert synced(parts, s.withColumn("instruction_text", F.lit(None).cast("string"))) == {"synced_required_fields_present"}
    assert synced(parts, s.withColumn("is_window_complete", F.lit(False))) == {"synced_quality_flags_pass"}
    assert synced(parts, lineage={"target_snapshot_id": 1}) == {"sync_lineage_snapshot_matches_table"}
    assert synced(parts, stats={}) == {"sync_stats_count_matches_table"}


def test_annotation_faults(parts):
    table, document = parts["annotations"], parts["document"]

    def run(rows=table, snapshot_id=parts["annotation_id"], lineage=document["annotation_lineage"], stats=document["annotation_stats"]):
        return failing(K.annotation_checks(rows, parts["config"], snapshot_id, lineage, stats))

    assert run() == set() and run(lineage=None, stats=None) == set()
    assert run(table.limit(0)) == {"annotation_table_not_empty", "annotation_stats_count_matches_table"}
    assert run(snapshot_id=None) == {"annotation_table_snapshot_exists", "annotation_lineage_snapshot_matches_table"}
    assert run(table.union(table.limit(1))) == {"annotation_episode_instruction_unique", "annotation_stats_count_matches_table"}
    assert run(table.withColumn("text", F.lit(None).cast("string"))) == {"annotation_required_fields_present"}
    assert run(stats={"annotations": 1}) == {"annotation_stats_count_matches_table"}
    # an inactive row is still a row of the table
    one_off = table.withColumn("is_active", F.col("annotation_type") == "source_task")
    assert run(one_off) == set()


def test_manifest_faults(parts):
    m, d = parts["manifest"], parts["document"]
    registry = {n: d[n] for n in ("metadata", "lineage", "stats")}

    def run(rows=m, json_rows=None, registry=registry, synced_id=parts["synced_id"]):
        lines = m if json_rows is None else json_rows
        return failing(
            K.manifest_checks(rows, lines, parts["samples"], parts["annotations"], parts["config"], synced_id, registry)
        )

    assert run() == set()
    assert run(json_rows=m.limit(3)) == {"manifest_jsonl_count_matches_parquet"}
    gone = m.limit(0)
    assert {"manifest_parquet_not_empty", "manifest_count_matches_source_view"} <= run(gone, gone)
    fewer = m.where("anchor_frame = 30")
    assert run(fewer, fewer) == {"manifest_count_matches_source_view", "manifest_hash_matches_registry"}
    twice = m.withColumn("sample_id", F.lit("same"))
    assert run(twice) == {"manifest_sample_id_unique", "manifest_hash_matches_registry"}
    assert "manifest_required_fields_present" in run(m.withColumn("scene_label", F.lit(None).cast("string")))
    assert "manifest_windows_valid" in run(m.withColumn("action_start_frame", F.col("observation_end_frame")))
    assert run(registry={**registry, "stats": {}}) == {"manifest_hash_matches_registry"}
    assert run(synced_id=1) == {"manifest_source_snapshot_matches_synced_table"}
    mixed = m.withColumn("annotation_snapshot_id", F.when(F.col("anchor_frame") == 30, 1).otherwise(F.col("annotation_snapshot_id")))
    assert run(mixed) == {"manifest_annotation_snapshot_matches_lineage"}


def test_export_faults(spark, built, parts):
    base, summary, store = built
    path, m = summary["export_dir"], parts["manifest"]
    data, episodes = (spark.read.parquet(f"{path}/{n}") for n in ("data", "meta/episodes"))
    refs = files.read_json_lines(spark, f"{path}/meta/sample_refs")
    documents = {
        "info": files.read_document(spark, f"{path}/meta/info.json"),
        "stats": files.read_document(spark, f"{path}/meta/stats.json"),
        "lineage": files.read_document(spark, f"{path}/meta/export_lineage.json"),
    }
    registry = {"metadata": documents["info"], "stats": documents["stats"], "lineage": documents["lineage"]}

    def run(m=m, data=data, episodes=episodes, refs=refs, registry=registry, **changes):
        return failing(export_checks(m, data, episodes, refs, {**documents, **changes}, registry))

    assert run() == set()
    assert run(episodes=episodes.limit(1)) == {"episode_rows_match_data_rows"}
    assert run(refs=refs.limit(1)) == {"sample_refs_match_data_rows"}
    assert run(refs=refs.withColumn("sample_id", F.lit("x"))) == {"sample_refs_are_unique"}
    assert run(data=data.withColumn("sample_id", F.lit("x"))) == {"sample_ids_are_unique"}
    assert run(data=data.drop("sync_status")) == {"required_columns_present"}
    assert run(info={}) == {"info_total_frames_match_data_rows", "info_manifest_sha256_match"}
    assert run(stats={}) == {"stats_total_samples_match_data_rows"}
    assert run(lineage={}) == {"lineage_manifest_rows_match", "lineage_manifest_sha256_match"}
    assert run(registry={}) == {"registry_metadata_exists", "registry_stats_exists", "registry_lineage_exists"}
    assert run(registry={**registry, "lineage": {"manifest_sha256": "x"}}) == {"registry_lineage_sha256_match"}
    assert {"manifest_rows_match_data_rows", "lineage_manifest_rows_match"} <= run(m=m.limit(1))


def test_export_validation_stops_on_missing_parts(spark, built, tmp_path):
    report = validate_export(spark, str(tmp_path), built[2].read(B.MANIFEST))
    assert report["status"] == "failed" and len(report["missing_files"]) == 7


def test_metrics(spark):
    df = spark.createDataFrame([(None, True), (None, None), ("a", False)], "k string, is_window_complete boolean")
    assert df.agg(C.duplicate_rows(["k"])).first()[0] == 1
    assert df.agg(C.null_rows([])).first()[0] == 0
    assert df.agg(C.failed_flags(["is_window_complete"])).first()[0] == 1
    assert C.duplicate_groups(df, ["k"]).first()[0] == 1
    three = spark.createDataFrame([("a", "error"), ("b", "ok"), ("c", "warning")], "name string, status string")
    assert tuple(C.report_totals(three).first()) == ("failed", 1, 1)


def test_missing_video_is_reported_not_fatal(spark, built):
    _, _, store = built
    refs = spark.createDataFrame(
        [("0", 0, "k", "p0", False), ("1", 0, "k", "p0", False), ("99", 0, "k", "p9", False)],
        "episode_id string, position long, video_key string, path string, exists boolean",
    )
    stats = E.export_stats(store.read(B.MANIFEST), refs).first()
    assert stats["missing_video_ref_count"] == 1 and stats["export_total_tasks"] == 4


def test_inactive_rules_are_not_counted(spark, built, tmp_path):
    base, summary, _ = built
    labels = {"task_label": "t", "object_label": "o", "scene_label": "s"}
    rules = (AnnotationRule("Pick.", ("Grab.",), **labels), AnnotationRule("Place.", ("Put.",), is_active=False, **labels))
    mine = settings(
        base, warehouse_dir=str(tmp_path / "w"), registry_dir=str(tmp_path / "r"), export_dir=str(tmp_path / "e"), inspect=False,
        annotation=AnnotationConfig(version="v1", policy="p", created_at_utc="now", rules=rules, require_status="ok", **labels),
    )
    other = B.run_build(spark, mine)
    assert other["annotations"] == 12 + 6
    assert SnapshotStore(spark, str(tmp_path / "w")).read(B.ANNOTATIONS).count() == 12 + 6 + 6
    assert other["manifest_version"] == other["export_version"] != summary["manifest_version"]


def test_summary_shows_an_export_of_another_manifest():
    report = {"status": "passed", "raw": {"frames": 1, "episodes": 1}, "synced": {"rows": 1, "required_status_rows": 1}, "annotations": 0}
    export = dict.fromkeys(("export_total_samples", "source_sample_count", "source_episode_count", "missing_video_ref_count"), 0)
    commit = B.Commit(1, "t", "p", 0, "now")
    summary = B.build_summary(report, report, {**export, "export_version": "old", "export_dir": "d"}, commit, "new")
    assert (summary["manifest_version"], summary["export_version"]) == ("new", "old")


def test_offenders_are_all_kept(spark, snapshot, tmp_path):
    many = spark.range(400).select(F.col("id").alias("episode_index"), F.lit(7).alias("length"))
    bad = changed(snapshot, episodes=many)
    report = contract_report(bad, str(tmp_path / "off"))
    row = next(r for r in report["checks"] if r["name"] == "episode_lengths_match_frames")
    details = json.loads(row["details"])
    assert details["mismatch_count"] == "400" and details["preview_rows"] == "20"
    assert json.loads(details["preview"])[:3] == ["0", "1", "2"]
    assert spark.read.parquet(details["offenders"]).where("check = 'episode_lengths_match_frames'").count() == 400


def test_build_leaves_no_scratch(spark, built):
    from strideframe.sources import scratch

    place = scratch.new_path(spark, "probe")
    folder = os.path.dirname(place.removeprefix("file://"))
    assert not [n for n in os.listdir(folder) if n.startswith("build-")]
