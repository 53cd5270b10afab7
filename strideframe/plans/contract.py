"""Source contract: is a raw snapshot complete and consistent enough to build from?"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.operators import checks as C
from strideframe.operators.video import video_refs
from strideframe.sources import files, scratch
from strideframe.sources.small import literal_table, one_row

SUITE = "contract"
CONTRACT_NAME = "episode_contract_v1"
REQUIRED_FRAME_COLUMNS = ["episode_index", "frame_index", "task_index", "timestamp"]
#: offenders shown in a report; all of them are in the table it names
PREVIEW = 20
ACTION_NAMES = ["action", "action.continuous", "action.discrete"]


@dataclass(frozen=True)
class Snapshot:
    """What was found of a raw snapshot; missing parts are None."""

    frames: DataFrame | None
    episodes: DataFrame | None
    tasks: DataFrame | None
    listing: DataFrame
    info: dict[str, Any] = field(default_factory=dict)
    path: str = ""


def load_snapshot(spark: SparkSession, path: str) -> Snapshot:
    def attempt(read, *where):
        for place in where:
            try:
                return read(spark, f"{path}/{place}")
            except FileNotFoundError:
                continue
        return None

    def either(stem: str) -> DataFrame | None:
        parquet = "meta/episodes" if stem == "episodes" else "meta/tasks.parquet"
        found = attempt(files.read_parquet_tree, parquet)
        return found if found is not None else attempt(files.read_json_lines, f"meta/{stem}.jsonl")

    return Snapshot(
        frames=attempt(files.read_parquet_tree, "data"),
        episodes=either("episodes"),
        tasks=either("tasks"),
        listing=files.list_files(spark, path),
        info=files.read_document(spark, f"{path}/meta/info.json"),
        path=path,
    )


def observation_features(info: dict[str, Any], names: list[str]) -> list[str]:
    """Observation features that frames hold as columns: those in the data and those declared, but no videos."""
    declared = info["features"] if isinstance(info.get("features"), dict) else {}
    videos = {key for key, feature in declared.items() if not isinstance(feature, dict) or feature.get("dtype") == "video"}
    wanted = [*names, *(key for key in declared if key not in videos)]
    return sorted({key for key in wanted if key.startswith("observation.")})


def fixed_check(name: str, ok: Any, details: dict[str, Any]) -> Column:
    """A check row from values the driver holds."""
    return C.check(SUITE, name, F.lit(bool(ok)), {k: F.lit(str(v)) for k, v in details.items()})


#: checks on the order of an episode's frames, by the column that marks a faulty episode
ORDER_FAULTS = {
    "timestamp_monotonic_by_episode": "timestamp_non_monotonic",
    "frame_index_monotonic_by_episode": "frame_non_monotonic",
    "frame_index_unique_by_episode": "frame_duplicated",
    "frame_index_contiguous_by_episode": "frame_gap",
}


def frame_offenders(
    order: DataFrame, frames: DataFrame, episodes: DataFrame | None, tasks: DataFrame | None
) -> DataFrame:
    """``check, key``: every faulty episode and uncovered task. ``order`` is the table of :func:`C.episode_order`."""
    flags = F.array(*[F.struct(F.lit(name).alias("check"), F.col(fault).alias("bad")) for name, fault in ORDER_FAULTS.items()])
    found = order.select(F.col("episode_index").cast("string").alias("key"), F.explode(F.filter(flags, lambda x: x["bad"])).alias("x"))
    rows = found.select("x.check", "key")
    if episodes is not None:
        counted = order.select(F.col("episode_index").alias("_e"), F.col("frame_rows").alias("_n"))
        wrong = C.length_mismatches(episodes, counted).select(F.col("episode_index").cast("string").alias("key"))
        rows = rows.union(wrong.select(F.lit("episode_lengths_match_frames").alias("check"), "key"))
    known = tasks if tasks is not None and "task_index" in tasks.columns else literal_table(frames.sparkSession, [], "task_index long")
    bare = C.uncovered_tasks(frames, known).select(F.col("task_index").cast("string").alias("key"))
    return rows.union(bare.select(F.lit("task_metadata_covers_frame_tasks").alias("check"), "key"))


@dataclass(frozen=True)
class Offenders:
    """How many offenders each check has, the first few, and where all of them are."""

    counts: dict[str, int]
    first: dict[str, str]
    path: str

    def details(self, check: str, counted: str) -> dict[str, Any]:
        return {
            counted: self.counts.get(check, 0),
            "preview": self.first.get(check, "[]"),
            "preview_rows": min(PREVIEW, self.counts.get(check, 0)),
            "offenders": self.path,
        }


def keep_offenders(rows: DataFrame, place: str) -> Offenders:
    """Store all offenders as a table at ``place`` and sum them up."""
    rows.write.mode("overwrite").parquet(place)
    summary = C.offender_summary(rows.sparkSession.read.schema(rows.schema).parquet(place), PREVIEW).first()
    return Offenders(summary["n"], summary["first"], place)


def frame_quality_checks(
    frames: DataFrame,
    episodes: DataFrame | None,
    tasks: DataFrame | None,
    offenders_dir: str | None = None,
    order: DataFrame | None = None,
) -> DataFrame:
    """The six checks on frame content. Frames are read twice: for their order and counts (``order``, the stored table of
    :func:`C.episode_order`, if it is there already), and for their tasks."""
    spark = frames.sparkSession
    order = order if order is not None else scratch.store(C.episode_order(frames), "episode-order")
    place = f"{offenders_dir}/frames" if offenders_dir else scratch.new_path(spark, "frame-offenders")
    found = keep_offenders(frame_offenders(order, frames, episodes, tasks), place)
    total = order.count()
    rows = [
        fixed_check(name, not found.counts.get(name), {"episodes": total, **found.details(name, "faulty_episodes")})
        for name in ORDER_FAULTS
    ]
    for name, counted in (("episode_lengths_match_frames", "mismatch_count"), ("task_metadata_covers_frame_tasks", "missing_tasks")):
        rows.append(fixed_check(name, not found.counts.get(name), found.details(name, counted)))
    return C.check_rows(one_row(spark), rows)


def contract_checks(snapshot: Snapshot, offenders_dir: str | None = None) -> DataFrame:
    """The contract as check rows. All offenders are stored below ``offenders_dir`` (unset: the scratch folder)."""
    spark = snapshot.listing.sparkSession
    info, frames = snapshot.info, snapshot.frames
    names = frames.columns if frames is not None else []
    absent = [n for n in REQUIRED_FRAME_COLUMNS if n not in names]
    actions = [n for n in ACTION_NAMES if n in names]
    observations = observation_features(info, names)

    def rows_of(df: DataFrame | None) -> int:
        return df.count() if df is not None else 0

    counts = {"episodes": rows_of(snapshot.episodes), "tasks": rows_of(snapshot.tasks)}
    of_frames = F.col("path").startswith("data/") & F.col("path").endswith(".parquet")
    n_files = snapshot.listing.agg(F.count(F.lit(1)).alias("all"), F.count_if(of_frames).alias("frames")).first()

    fixed = fixed_check
    one = one_row(spark)
    result = C.check_rows(
        one,
        [
            fixed("snapshot_dir_exists", n_files["all"] > 0, {"path": snapshot.path}),
            fixed("info_json_exists", info, {"path": f"{snapshot.path}/meta/info.json"}),
            fixed("frame_parquet_exists", frames is not None, {"files": n_files["frames"]}),
            fixed("episode_metadata_exists", counts["episodes"] > 0, {"rows": counts["episodes"]}),
            fixed("task_metadata_exists", counts["tasks"] > 0, {"rows": counts["tasks"]}),
            fixed("required_frame_columns_present", not absent, {"missing": absent}),
            fixed("action_column_exists", actions, {"action_columns": actions}),
            fixed("observation_column_exists", observations, {"observation_columns": observations}),
            fixed("video_path_template_exists", info.get("video_path"), {"video_path": info.get("video_path")}),
        ],
    )
    name, expected = "video_refs_resolvable", 0
    if snapshot.episodes is not None:
        refs = video_refs(snapshot.episodes, snapshot.listing, info)
        place = f"{offenders_dir}/videos" if offenders_dir else scratch.new_path(spark, "video-offenders")
        missing = refs.where(~F.col("exists")).select(F.lit(name).alias("check"), F.col("path").alias("key"))
        found, expected = keep_offenders(missing, place), refs.count()
    else:
        found = Offenders({}, {}, "")
    resolvable = expected > 0 and not found.counts.get(name)
    details = {"expected_refs": expected, **found.details(name, "missing_refs")}
    result = result.union(C.check_rows(one, [fixed(name, resolvable, details)]))
    keys = [*actions, *observations]
    not_run = C.check_rows(one, [fixed("frame_quality_checks_runnable", False, {"missing": absent})])
    if frames is None:
        return result.union(not_run).union(shape_check(literal_table(spark, [], C.SHAPE_SCHEMA)))
    if absent:
        return result.union(not_run).union(shape_check(C.vector_shapes(frames, keys, info)))
    # one pass over the frames for the order of every episode and for the vector lengths
    measured, stated = C.expected_lengths(names, keys, info)
    wrong = {f"b{i}": C.wrong_length(frames, key, n) for i, (key, n) in enumerate(measured.items())}
    order = scratch.store(C.episode_order(frames, faults=wrong), "episode-order")
    if order.isEmpty():
        result = result.union(not_run)
    else:
        result = result.union(frame_quality_checks(frames, snapshot.episodes, snapshot.tasks, offenders_dir, order))
    totals = order.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in wrong]) if wrong else one
    return result.union(shape_check(C.shape_rows(totals, measured, stated)))


def shape_check(shapes: DataFrame) -> DataFrame:
    """One check row from a row per feature of the description."""
    totals = shapes.agg(
        F.count_if(F.col("status") == "error").alias("bad"),
        F.to_json(F.array_sort(F.collect_list(F.struct(*shapes.columns)))).alias("features"),
    )
    name = "action_observation_shapes_match_info"
    return C.check_rows(totals, [C.check(SUITE, name, F.col("bad") == 0, {"features": F.col("features")})])


def contract_report(snapshot: Snapshot, offenders_dir: str | None = None) -> dict[str, Any]:
    """The contract checks with a summary of the snapshot, as a document."""
    rows = [row.asDict() for row in contract_checks(snapshot, offenders_dir).collect()]
    errors = sum(row["status"] == "error" for row in rows)
    info = snapshot.info
    return {
        "contract": CONTRACT_NAME,
        "snapshot_dir": snapshot.path,
        "status": "failed" if errors else "passed",
        "error_count": errors,
        "warning_count": sum(row["status"] == "warning" for row in rows),
        "summary": {
            "codebase_version": info.get("codebase_version"),
            "robot_type": info.get("robot_type"),
            "declared_episodes": info.get("total_episodes"),
            "declared_frames": info.get("total_frames"),
            "declared_tasks": info.get("total_tasks"),
        },
        "checks": rows,
    }
