"""Tables the registered queries start from, derived once per session and data folder and stored.

In a build every step reads the table the step before it has written; the queries do the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog import fixtures as X
from strideframe.operators import annotations as A
from strideframe.operators import manifest as M
from strideframe.operators.export import export_rows, export_tasks
from strideframe.operators.ordering import indexed_rows
from strideframe.operators.sync import synced_samples
from strideframe.operators.video import video_refs
from strideframe.sources import scratch

_paths: dict[tuple[str, str, str], str] = {}


def _synced(spark: SparkSession, sf: str) -> DataFrame:
    return synced_samples(get(spark, sf, "frames"), get(spark, sf, "tasks"), X.FE_SYNC)


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.annotated_manifest(
        get(spark, sf, "synced"), get(spark, sf, "annotations"), X.MANIFEST, X.ANNOTATION_SNAPSHOT
    )
    return M.sort_manifest(rows)


def _video_refs(spark: SparkSession, sf: str) -> DataFrame:
    return video_refs(get(spark, sf, "episodes"), get(spark, sf, "files"))


def _export(spark: SparkSession, sf: str) -> DataFrame:
    indexed = indexed_rows(get(spark, sf, "manifest"))
    return export_rows(indexed, export_tasks(indexed), get(spark, sf, "frames"))


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "frames": X.event_frames,
    "lines": X.line_frames,
    "skewed": X.skewed_frames,
    "turns": X.turn_frames,
    "tasks": lambda spark, sf: X.task_table(spark),
    "episodes": lambda spark, sf: X.episode_metadata(get(spark, sf, "frames")),
    "files": lambda spark, sf: X.video_files(get(spark, sf, "episodes")),
    "synced": _synced,
    "annotations": lambda spark, sf: A.annotations(get(spark, sf, "synced"), X.ANNOTATE),
    "manifest": _manifest,
    "video_refs": _video_refs,
    "export": _export,
}


def path(spark: SparkSession, sf: str, name: str) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _paths:
        place = scratch.new_path(spark, f"catalog-{name}")
        BUILDERS[name](spark, sf).write.parquet(place)
        _paths[key] = place
    return _paths[key]


def get(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(path(spark, sf, name))
