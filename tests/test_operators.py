"""Edge rows of names, frames, annotations, manifests, videos, shards and ordering."""

import hashlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strideframe.config import (
    AnnotationConfig,
    AnnotationRule,
    EpisodeFilter,
    FrameColumns,
    FrameManifestConfig,
    ManifestConfig,
    SyncConfig,
    WindowSpec,
    config_hash,
)
from strideframe.functions.columns import first_present, normalize_columns, require_columns, safe_names
from strideframe.functions.digest import content_digest
from strideframe.functions.integers import floor_div
from strideframe.functions.paths import template_path
from strideframe.operators import annotations as A
from strideframe.operators import export as E
from strideframe.operators import manifest as M
from strideframe.operators import resolve as R
from strideframe.operators import shards as S
from strideframe.operators import video as V
from strideframe.operators.frames import attach_task_text, derive_episodes, filter_episodes, select_frames
from strideframe.operators.ordering import indexed_rows, with_global_index, with_group_position
from strideframe.sources import files, scratch
from strideframe.sources.snapshots import SnapshotStore


# --- names and integers ------------------------------------------------------------------------------------------------


def test_safe_names():
    assert safe_names(["a.b", "A b", "a_b", "1x", ".."]) == ["a_b", "a_b_2", "a_b_3", "col_1x", "col"]
    assert safe_names(["a_2", "a", "a"]) == ["a_2", "a", "a_3"]
    assert safe_names(["__X__y--z", "é"]) == ["x_y_z", "col"]


def test_normalize_handles_dots(spark):
    df = spark.createDataFrame([(1, 2)], ["task.instructions", "task instructions"])
    assert normalize_columns(df).columns == ["task_instructions", "task_instructions_2"]


def test_required_and_first_present(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        require_columns(df, ["c", "a", "b"])
    assert first_present(["x", "index"], ["frame_index", "index"]) == "index"
    assert first_present(["x"], ["y"]) is None


def test_integer_division(spark):
    values = [-11, -10, -1, 0, 1, 9, 10, 2**53 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert all(r["f"] == r["v"] // 5 for r in df.select("v", floor_div("v", 5).alias("f")).collect())


def test_template(spark):
    template = "100%/{video_key}/{episode_chunk:03d}/{episode_index:06d}-{episode_index}.mp4"
    values = {"video_key": F.lit("front"), "episode_chunk": F.lit(2), "episode_index": F.lit(1234567)}
    got = spark.range(1).select(template_path(template, values).alias("p")).first()["p"]
    assert got == template.format(video_key="front", episode_chunk=2, episode_index=1234567)
    with pytest.raises(ValueError, match="chunk_index"):
        template_path("{chunk_index}", values)


# --- config ------------------------------------------------------------------------------------------------------------


def test_configs_from_mappings():
    sync = SyncConfig.from_mapping(
        {
            "columns": {"episode": "e", "frame": "f", "timestamp": "t", "task": "k"},
            "frame_stride": 7,
            "window": {"observation_start_offset": -3},
            "quality": {"max_timestamp_gap_seconds": 2},
            "episode_filter_start": 2,
            "episode_filter_count": 3,
            "episode_limit": 9,
        }
    )
    assert (sync.stride, sync.window.observation_start_offset, sync.max_gap_seconds) == (7, -3, 2.0)
    assert sync.episodes.values() == [2, 3, 4]
    planner = EpisodeFilter.from_mapping({"episode_limit": 9, "episode_filter_count": 3}, ("episode_limit", "episode_filter_count"))
    assert planner.count == 9
    assert EpisodeFilter.from_mapping({"episode_filter": [4, 1], "episode_limit": 2}).values() == [4, 1]
    annotation = AnnotationConfig.from_mapping(
        {
            "annotation_version": "v",
            "annotation_policy": "p",
            "default_task_label": "t",
            "default_object_label": "o",
            "additional_annotations": [{"match_text": "m", "texts": ["a", "b"]}],
        },
        "now",
    )
    rule = annotation.rules[0]
    assert (rule.annotation_type, rule.task_label, rule.object_label, rule.is_active) == ("paraphrase", "t", None, True)
    with pytest.raises(ValueError):
        SyncConfig(stride=0)


def test_config_hash_ignores_key_order():
    assert config_hash({"a": 1, "b": "é"}) == config_hash({"b": "é", "a": 1})
    assert config_hash({"a": 1}) == hashlib.sha256(b'{"a": 1}').hexdigest()


# --- frames ------------------------------------------------------------------------------------------------------------


def test_task_text_sources(spark):
    rows = [(0, 0, 0.0, 1, "own"), (0, 1, 0.0, 1, None), (0, 2, 0.0, 2, None), (0, 3, 0.0, None, None)]
    frames = spark.createDataFrame(rows, "e long, f long, t double, k long, i string")
    columns = FrameColumns("e", "f", "t", "k", instruction="i", sensor_timestamp="absent")
    tasks = spark.createDataFrame([(1, "one"), (1, "another")], "task_index long, task string")
    selected = select_frames(frames, columns)
    texts = {r["frame"]: r["instruction_text"] for r in attach_task_text(selected, tasks).collect()}
    assert texts == {0: "own", 1: "another", 2: "task_2", 3: None}
    texts = {r["frame"]: r["instruction_text"] for r in attach_task_text(selected, None).collect()}
    assert texts == {0: "own", 1: "task_1", 2: "task_2", 3: None}


def test_long_episode_list_is_a_semi_join(spark):
    df = spark.range(3000).withColumnRenamed("id", "e")
    kept = filter_episodes(df, "e", EpisodeFilter(episodes=tuple(range(5, 1500)) + (5, 5)))
    assert kept.count() == 1495


def test_derive_episodes_uses_what_is_there(spark):
    frames = spark.createDataFrame([(1, 5), (1, 3), (0, 3)], "episode_index long, task_index long")
    rows = [tuple(r) for r in derive_episodes(frames).collect()]
    assert rows == [(0, 1, [3]), (1, 2, [3, 5])]
    with pytest.raises(ValueError):
        derive_episodes(frames.drop("episode_index"))


# --- annotations -------------------------------------------------------------------------------------------------------

SAMPLES = "episode_id string, instruction_id string, instruction_text string, sync_status string"


def annotation_config(*rules, **changes):
    return AnnotationConfig(**{"version": "v1", "policy": "p", "created_at_utc": "now", "rules": rules, **changes})


def test_annotation_rules_match_exact_text(spark):
    samples = spark.createDataFrame(
        [("1", "task_0", "Go.", "ok"), ("1", "task_0", "Go.", "ok"), ("1", "task_1", None, "ok"), ("2", "task_0", "Go.", "bad")],
        SAMPLES,
    )
    config = annotation_config(
        AnnotationRule("Go.", ("Move.", "Go.")), AnnotationRule("go.", ("Never.",)), require_status="ok", task_label="t"
    )
    rows = A.annotations(samples, config).collect()
    assert sorted((r["text"], r["annotation_type"], r["task_label"]) for r in rows) == [
        ("Go.", "paraphrase", None),
        ("Go.", "source_task", "t"),
        ("Move.", "paraphrase", None),
    ]
    assert len({r["instruction_id"] for r in rows}) == 3
    seed = "||".join(["1", "task_0", "Move.", "paraphrase", "v1", "p"])
    moved = next(r for r in rows if r["text"] == "Move.")
    assert moved["instruction_id"] == "inst_" + hashlib.sha256(seed.encode()).hexdigest()[:16]


def test_no_rules_and_repeated_rules(spark):
    samples = spark.createDataFrame([("1", "task_0", "Go.", "ok")], SAMPLES)
    assert A.annotations(samples, annotation_config()).count() == 1
    assert A.rule_table(spark, annotation_config()).count() == 0
    off = AnnotationRule("Go.", ("Move.",), is_active=False, task_label="a")
    on = AnnotationRule("Go.", ("Move.",), task_label="b")
    kept = A.annotations(samples, annotation_config(off, on)).where("annotation_type = 'paraphrase'").collect()
    assert [(r["is_active"], r["task_label"]) for r in kept] == [(True, "b")]


def test_empty_annotation_summary(spark):
    empty = spark.createDataFrame([], "episode_id string, annotation_type string")
    assert tuple(A.per_episode_summary(empty).first()) == (0, 0, 0)


def test_active_filter_skips_absent_columns(spark):
    bare = spark.createDataFrame([("1",)], "episode_id string")
    assert A.active_annotations(bare, True, "v1").count() == 1


# --- manifest ----------------------------------------------------------------------------------------------------------


def test_inactive_and_other_versions_are_left_out(spark):
    samples = spark.createDataFrame(
        [("s", "1", "task_0", "Go.", *range(5), *[0.0] * 5, 5, 4, 0.0, "ok", "r", "t", 1)],
        "sample_id string, episode_id string, instruction_id string, instruction_text string, anchor_frame long,"
        "observation_start_frame long, observation_end_frame long, action_start_frame long, action_end_frame long,"
        "anchor_timestamp double, observation_start_timestamp double, observation_end_timestamp double,"
        "action_start_timestamp double, action_end_timestamp double, observation_rows long, action_rows long,"
        "max_timestamp_gap_seconds double, sync_status string, sync_rule string, source_frames_table string,"
        "source_frames_snapshot_id long",
    )
    base = A.annotations(samples, annotation_config(AnnotationRule("Go.", ("A.", "B.", "C."))))
    table = base.withColumn("is_active", F.col("text") != "A.").withColumn(
        "annotation_version", F.when(F.col("text") == "B.", "v0").otherwise(F.col("annotation_version"))
    )
    config = ManifestConfig(annotation_version="v1", join_columns=("source_instruction_id", "ignored"))
    manifest = M.annotated_manifest(samples, table, config, 3)
    assert len(manifest.columns) == 33
    assert sorted(r["instruction_text"] for r in manifest.collect()) == ["C.", "Go."]
    assert M.expected_rows(samples, table, config).first()[0] == 2
    assert M.expected_rows(samples, None, config).first()[0] == 1
    assert len(M.plain_manifest(samples, config).columns) == 21
    assert M.plain_manifest(samples.drop("sync_rule"), config).columns == [c for c in M.PLAIN_COLUMNS if c != "sync_rule"]


def test_manifest_order_is_text_order(spark):
    df = spark.createDataFrame([("2", 5), ("10", 5), ("10", 1)], "episode_id string, anchor_frame long")
    assert [tuple(r) for r in M.sort_manifest(df).collect()] == [("10", 1), ("10", 5), ("2", 5)]


def test_frame_manifest_defaults(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "other long")
    rows = M.frame_manifest(df, FrameManifestConfig(stride=10, window=WindowSpec(-5, 0, 1, 2))).collect()
    assert sorted(r["sample_id"] for r in rows) == [
        "sample_ep_unknown_task_inst_unknown_10",
        "sample_ep_unknown_task_inst_unknown_20",
    ]
    assert M.frame_manifest(df, FrameManifestConfig(episodes=(1,))).count() == 0


def test_frame_manifest_reads_seconds_as_frames(spark):
    df = spark.createDataFrame([("e", 30.7, "hi")], "episode string, timestamp double, `task.policy` string")
    row = M.frame_manifest(df, FrameManifestConfig()).first()
    assert (row["anchor_frame"], row["instruction_text"], row["instruction_id"]) == (30, "hi", "task_inst_unknown")


def test_digest_depends_on_content_only(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    whole = content_digest(df).first()
    assert content_digest(df.repartition(13).orderBy(F.desc("id"))).first() == whole
    assert content_digest(df.where("id <> 5")).first() != whole
    assert content_digest(df.union(df.where("id = 5"))).first() != whole
    assert content_digest(df.limit(0)).first()["rows"] == 0


# --- ordering ----------------------------------------------------------------------------------------------------------


def test_global_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(9)
    rows = with_global_index(df, ["v"]).collect()
    assert len(rows) == 1000 and all(r["v"] == r["index"] for r in rows)


def test_global_index_of_equal_rows(spark):
    df = spark.range(500).select(F.lit("same").alias("v")).repartition(5)
    assert sorted(r["index"] for r in with_global_index(df, ["v"]).collect()) == list(range(500))


def test_index_follows_numeric_part_order(spark):
    path = scratch.new_path(spark, "parts")
    spark.range(0, 40, 1, 12).write.parquet(path)
    rows = indexed_rows(spark.read.parquet(path)).collect()
    assert all(r["id"] == r["index"] for r in rows)


def test_group_position(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 200).alias("v"))
    df = df.withColumn("cell", F.floor(F.col("v") / 10))
    rows = with_group_position(df, ["g"], "cell", ["v"]).collect()
    for g in range(3):
        mine = sorted((r["v"], r["position"]) for r in rows if r["g"] == g)
        assert [p for _, p in mine] == list(range(len(mine)))


# --- videos and shards -------------------------------------------------------------------------------------------------


def episodes_v3(spark):
    rows = [(0, 1, 2, None, 5), (1, 0, 0, 0, 0), (2, None, None, None, None), (1, 3, 3, 3, 3)]
    names = ["episode_index", "videos/b/chunk_index", "videos/b/file_index", "videos/a/chunk_index", "videos/a/file_index"]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` long" for n in names))


INFO = {
    "video_path": "v/{episode_chunk:03d}/{video_key}/{episode_index:06d}.mp4",
    "chunks_size": 2,
    "features": {"z": {"dtype": "video"}, "c": {"dtype": "video"}, "x": {"dtype": "float32"}, "bad": 1},
}


def test_video_refs_fall_back_per_episode(spark):
    listing = spark.createDataFrame([("videos/b/chunk-001/file-002.mp4", 1), ("v/001/c/000002.mp4", 1)], "path string, length long")
    rows = V.video_refs(episodes_v3(spark), listing, INFO).orderBy("episode_id", "position").collect()
    assert [(r["episode_id"], r["video_key"], r["path"], r["exists"]) for r in rows] == [
        ("0", "b", "videos/b/chunk-001/file-002.mp4", True),
        ("1", "b", "videos/b/chunk-000/file-000.mp4", False),
        ("1", "a", "videos/a/chunk-000/file-000.mp4", False),
        ("2", "c", "v/001/c/000002.mp4", True),
        ("2", "z", "v/001/z/000002.mp4", False),
    ]


def test_numbered_template_and_text_episodes_have_no_template_refs(spark):
    listing = spark.createDataFrame([], files.LISTING_SCHEMA)
    numbered = {**INFO, "video_path": "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4"}
    assert V.video_refs(episodes_v3(spark), listing, numbered).where("episode_id = '2'").count() == 0
    text = spark.createDataFrame([("ep_a",), ("7",)], "episode_id string")
    assert {r["episode_id"] for r in V.video_refs(text, listing, INFO).collect()} == {"7"}
    with pytest.raises(ValueError):
        V.video_refs(listing, listing, INFO)


def test_shard_plan(spark):
    episodes = episodes_v3(spark)
    chosen = S.select_episodes(episodes, EpisodeFilter(start=1, count=1))
    assert {r["episode_index"] for r in chosen.collect()} == {1}
    assert [r["path"] for r in S.shard_paths(chosen, ["a"]).collect()] == [
        "videos/a/chunk-000/file-000.mp4",
        "videos/a/chunk-003/file-003.mp4",
    ]
    with pytest.raises(ValueError):
        S.select_episodes(episodes, EpisodeFilter())


def test_pattern_sizes(spark):
    listing = spark.createDataFrame(
        [("README.md", 5), ("meta/info.json", 7), ("metadata.json", 100), ("data/a/b.parquet", 11), ("meta/x/y", 1)],
        "path string, length long",
    )
    paths = spark.createDataFrame([("data/a/b.parquet",), ("gone.mp4",)], "path string")
    sizes = S.pattern_sizes(S.plan_patterns(paths), listing)
    found = {r["pattern"]: (r["files"], r["bytes"]) for r in sizes.collect()}
    assert found == {
        "README.md": (1, 5), "meta/**": (2, 8), "data/**": (1, 11), "data/a/b.parquet": (1, 11), "gone.mp4": (0, None),
    }
    assert tuple(S.plan_size(sizes).first()) == (5, 1, None)
    assert tuple(S.plan_size(sizes.where("files > 0")).first()) == (4, 0, 35)


def test_budget():
    S.check_budget(None, 1)
    S.check_budget(10, None)
    S.check_budget(1024**3, 1)
    with pytest.raises(ValueError):
        S.check_budget(1024**3 + 1, 1)


# --- resolve and export -------------------------------------------------------------------------------------------------

FRAMES = "episode_index long, frame_index long, timestamp double, task_index long, `observation.s` array<double>, action array<double>"


def frames_of(spark, numbers, episode=1):
    return spark.createDataFrame([(episode, n, n / 10, 0, [n * 1.0], [n * 2.0]) for n in numbers], FRAMES)


def manifest_of(spark, rows):
    schema = (
        "sample_id string, episode_id string, instruction_id string, instruction_text string, anchor_frame long,"
        "observation_start_frame long, observation_end_frame long, action_start_frame long, action_end_frame long"
    )
    return spark.createDataFrame(rows, schema)


def test_resolve(spark):
    manifest = manifest_of(
        spark,
        [("a", "1", "i", "t", 40, 0, 40, 41, 60), ("b", "1", "j", None, 40, 0, 40, 41, 60), ("c", "x", "i", "t", 5, 0, 5, 6, 9)],
    )
    frames = frames_of(spark, [n for n in range(100) if n % 3])
    rows = {r["sample_id"]: r for r in R.resolve_samples(manifest, frames).collect()}
    seen = [r["frame_index"] for r in rows["a"]["observation"]["records"]]
    assert seen == [n for n in range(41) if n % 3]
    assert rows["a"]["observation"]["columns"] == ["episode_index", "frame_index", "timestamp", "observation.s"]
    assert rows["a"]["action"]["columns"][-1] == "action" and rows["a"]["action"]["frame_range"] == [41, 60]
    assert rows["b"]["observation"]["rows"] == len(seen) and rows["c"]["action"]["rows"] == 0
    raw = R.resolve_samples(manifest, frames, raw=True).where("sample_id = 'a'").first()
    assert raw["action"]["columns"] == frames.columns
    short = R.preview(R.resolve_samples(manifest, frames), 2).where("sample_id = 'a'").first()
    assert len(short["observation"]["preview_records"]) == 2 and short["missing_video_count"] == 0
    assert R.resolved_frames(manifest, frames).where("sample_id = 'a'").count() == len(seen) + 13


def plain_windows(manifest, frames):
    """sample id -> role -> sorted frame numbers, by meeting every window with every frame."""
    out = {}
    for m in manifest:
        for role in R.ROLES:
            low, high = m[f"{role}_start_frame"], m[f"{role}_end_frame"]
            hit = [f for e, f in frames if str(e) == m["episode_id"] and low is not None and high is not None and low <= f <= high]
            out[m["sample_id"], role] = sorted(hit)
    return out


def test_nested_windows_of_all_widths(spark):
    rng = random.Random(3)
    rows = []
    for n in range(60):
        start, gap = rng.randrange(-40, 200), rng.randrange(-60, 60)
        sizes = [rng.choice([-1, 0, 1, 2, 7, 8, 15, 16, 90]) for _ in range(2)]
        rows.append((f"s{n}", str(rng.randrange(3)), "i", "t", start, start, start + sizes[0], start + gap, start + gap + sizes[1]))
    rows.append(("none", "0", "i", "t", None, None, None, None, None))
    manifest = manifest_of(spark, rows)
    numbers = [(e, f) for e in range(3) for f in range(-20, 180) if rng.random() < 0.8] + [(1, 50), (1, 50)]
    frames = spark.createDataFrame([(e, f, f * 0.1, 0, [float(f)], [f * 2.0]) for e, f in numbers], FRAMES)
    want = plain_windows([r.asDict() for r in manifest.collect()], numbers)
    for raw in (False, True):
        found = R.resolve_samples(manifest, frames, raw=raw)
        got = {(r["sample_id"], role): [x["frame_index"] for x in r[role]["records"]] for r in found.collect() for role in R.ROLES}
        assert got == want
    short = R.preview_samples(manifest, frames, records=2).collect()
    assert {(r["sample_id"], role): ([x["frame_index"] for x in r[role]["preview_records"]], r[role]["rows"]) for r in short for role in R.ROLES} == {
        key: (numbers[:2], len(numbers)) for key, numbers in want.items()
    }
    whole = R.preview(R.resolve_samples(manifest, frames), 2)
    assert R.preview_samples(manifest, frames, records=2).schema.simpleString() == whole.schema.simpleString()


def test_nested_windows_gather_each_frame_once(spark):
    manifest = manifest_of(spark, [(f"s{n}", "1", "i", "t", n, n - 5, n, n + 1, n + 5) for n in range(10, 60, 10)])
    found = R.resolve_samples(manifest, frames_of(spark, range(80)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "Cartesian" not in plan


def test_resolve_text_episodes(spark):
    frames = frames_of(spark, range(10)).withColumn("episode_index", F.lit("ep"))
    manifest = manifest_of(spark, [("a", "ep", "i", "t", 5, 0, 5, 6, 9)])
    assert R.resolved_frames(manifest, frames).count() == 10


def exported(spark, manifest, frames):
    indexed = E.index_manifest(manifest)
    return E.export_rows(indexed, E.export_tasks(indexed), frames).orderBy("index")


def test_export_takes_window_edges(spark):
    manifest = manifest_of(
        spark,
        [("a", "1", "i", "t", 5, 1, 5, 6, 9), ("b", "1", "j", None, 5, 1, 5, 6, 9), ("c", "1", "i", "t", 10, 6, 10, 11, 14)],
    )
    frames = frames_of(spark, [n for n in range(20) if n not in (5, 6)]).union(
        spark.createDataFrame([(1, 4, 9.0, 0, [-1.0], [-2.0])], FRAMES)
    )
    rows = exported(spark, manifest, frames).collect()
    assert [(r["sample_id"], r["index"], r["episode_index"], r["task_index"]) for r in rows] == [
        ("a", 0, 0, 0), ("b", 1, 1, 1), ("c", 2, 2, 0),
    ]
    assert [r["observation.s"] for r in rows] == [[-1.0], [-1.0], [10.0]]
    assert [r["action"] for r in rows] == [[14.0], [14.0], [22.0]]
    assert rows[1]["task.instructions"] is None and rows[0]["source_sample_id"] == "a" and rows[0]["annotation_type"] is None
    tasks = E.export_tasks(E.index_manifest(manifest)).collect()
    assert sorted(tuple(r) for r in tasks) == [(0, "t"), (1, "")]
    episodes = E.export_episodes(exported(spark, manifest, frames)).collect()
    assert len(episodes[0]) == 19 and sorted(r["tasks"][0] for r in episodes) == ["", "t", "t"]


@pytest.mark.parametrize("missing", ["observation", "action"])
def test_export_fails_on_an_empty_window(spark, missing):
    manifest = manifest_of(spark, [("a", "1", "i", "t", 5, 1, 5, 6, 9)])
    frames = frames_of(spark, range(6, 20) if missing == "observation" else range(6))
    with pytest.raises(PySparkException, match="window is empty"):
        exported(spark, manifest, frames).select("index", "sample_id").collect()


def test_lineage_must_be_unique(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "sync_rule string, annotation_snapshot_id long")
    with pytest.raises(PySparkException, match="mixes values of sync_rule"):
        E.lineage_row(df).collect()
    row = E.lineage_row(df.where("sync_rule = 'a'")).first()
    assert (row["manifest_row_count"], row["sync_rule"], row["annotation_version"]) == (1, "a", None)


def test_feature_map(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1, 2, 3, [1.0], "x", [2])],
        "timestamp double, gap double, index long, action_rows long, n long, action array<double>, s string, extra array<long>",
    )
    info = {"features": {"action": {"dtype": "float32", "shape": [1]}}}
    described = E.export_info(df, info, {"export_total_samples": 1, "export_total_tasks": 1}, "f" * 64)
    kinds = {name: f["dtype"] for name, f in described["features"].items()}
    assert kinds == {
        "timestamp": "float32", "gap": "float32", "index": "int64", "action_rows": "int64", "n": "string",
        "action": "float32", "s": "string", "extra": "list",
    }
    assert described["features"]["extra"]["shape"] == [1] and described["splits"] == {"train": "0:1"}


# --- sources -------------------------------------------------------------------------------------------------------------


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_parquet_tree(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        files.read_json_lines(spark, str(tmp_path / "none.jsonl"))
    assert files.read_document(spark, str(tmp_path / "none.json")) == {}
    assert files.read_tasks(spark, str(tmp_path)) == (None, None)


def test_episode_source_priority(spark, tmp_path):
    frames = frames_of(spark, range(4))
    assert files.read_episodes(spark, str(tmp_path), frames)[1] == "derived_from_frames"
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "episodes.jsonl").write_text('{"episode_index": 1, "Some Length": 4}\n')
    found, label = files.read_episodes(spark, str(tmp_path), frames)
    assert label == "meta/episodes.jsonl" and found.columns == ["some_length", "episode_index"]
    spark.range(1).write.parquet(str(tmp_path / "meta" / "episodes" / "chunk-000"))
    assert files.read_episodes(spark, str(tmp_path), frames)[1] == "meta/episodes"


def test_listing(spark, tmp_path):
    (tmp_path / "videos" / "a").mkdir(parents=True)
    (tmp_path / "videos" / "a" / "x.mp4").write_bytes(b"12345")
    (tmp_path / "note.txt").write_text("n")
    listed = {r["path"]: r["length"] for r in files.list_files(spark, str(tmp_path)).collect()}
    assert listed == {"videos/a/x.mp4": 5, "note.txt": 1}
    nested = tmp_path / "data"
    again = nested / str(nested).lstrip("/")
    again.mkdir(parents=True)
    (again / "f").write_text("x")
    assert [r["path"] for r in files.list_files(spark, str(nested)).collect()] == [f"{str(nested).lstrip('/')}/f"]
    assert [r["path"] for r in files.list_files(spark, str(tmp_path), "*.mp4").collect()] == ["videos/a/x.mp4"]
    assert files.list_files(spark, str(tmp_path / "none")).count() == 0


def test_snapshots(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.latest_id("a.b") is None and store.read_optional("a.b") is None and store.log("a.b").count() == 0
    with pytest.raises(FileNotFoundError):
        store.read("a.b")
    first = store.write("a.b", spark.range(5))
    second = store.write("a.b", spark.range(7).withColumn("x", F.lit(1)))
    assert (first.operation, second.operation, first.rows, second.rows) == ("create", "replace", 5, 7)
    assert store.read("a.b").count() == 7 and store.read("a.b", first.snapshot_id).columns == ["id"]
    assert [r["rows"] for r in store.recent("a.b").collect()] == [7, 5]
    assert store.write("a.c", spark.range(0)).rows == 0 and store.read("a.c").count() == 0


def test_unfinished_write_is_invisible(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    kept = store.write("t.x", spark.range(3))
    with pytest.raises(PySparkException):
        store.write("t.x", spark.range(3).select(F.raise_error(F.lit("lost")).alias("id")))
    assert store.latest_id("t.x") == kept.snapshot_id and store.read("t.x").count() == 3


def test_shard_plan_totals(spark):
    listing = spark.createDataFrame([("videos/b/chunk-001/file-002.mp4", 9), ("data/x", 1)], "path string, length long")
    sizes, totals = S.shard_plan(episodes_v3(spark), listing, EpisodeFilter(episodes=(0,)), base=("data/**",), max_gib=1)
    assert totals == {"patterns": 2, "patterns_without_size": 0, "estimated_bytes": 10} and sizes.count() == 2
    with pytest.raises(ValueError, match="no episode metadata"):
        S.shard_plan(episodes_v3(spark), listing, EpisodeFilter(episodes=(77,)))
    with pytest.raises(ValueError, match="budget"):
        S.shard_plan(episodes_v3(spark), listing, EpisodeFilter(episodes=(0,)), base=("data/**",), max_gib=1e-9)


def test_episode_filter_and_columns_reach_the_scan(spark, tmp_path):
    frames_of(spark, range(50)).write.parquet(str(tmp_path / "f"))
    frames = spark.read.parquet(str(tmp_path / "f"))
    plan = select_frames(frames, FrameColumns(), EpisodeFilter(start=3, count=4))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(episode_index,3)" in plan and "LessThanOrEqual(episode_index,6)" in plan
    assert "observation" not in plan and "action" not in plan


def test_positions_need_part_file_names(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/t")
    assert sorted(r["index"] for r in indexed_rows(spark.read.parquet(f"{tmp_path}/t")).collect()) == list(range(10))
    one = next(p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-"))
    one.rename(one.with_name("renamed.parquet"))
    with pytest.raises(Exception, match="place is unknown"):
        indexed_rows(spark.read.parquet(f"{tmp_path}/t")).collect()
