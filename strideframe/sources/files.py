"""Raw inputs: frame, episode and task files, file listings, small documents."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.functions.columns import normalize_columns
from strideframe.sources.small import literal_table

LISTING_SCHEMA = "path string, length long"


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


#: most tasks that list folders at once
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks for every core; Spark's default is a task for every folder, up to 10,000."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def read_parquet_tree(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder; FileNotFoundError when there are none."""
    try:
        with _few_listing_tasks(spark):
            return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as error:
        if _is_missing(error):
            raise FileNotFoundError(f"no parquet files under {path}") from error
        raise


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.json(path)
    except AnalysisException as error:
        if _is_missing(error):
            raise FileNotFoundError(f"no JSON lines at {path}") from error
        raise


def _first_readable(spark: SparkSession, options: list[tuple[str, Any, str]]) -> tuple[DataFrame | None, str | None]:
    for label, reader, path in options:
        try:
            return normalize_columns(reader(spark, path)), label
        except FileNotFoundError:
            continue
    return None, None


def read_episodes(spark: SparkSession, snapshot_dir: str, frames: DataFrame) -> tuple[DataFrame, str]:
    """Episode metadata from Parquet, else JSON lines, else derived from the frames; and which one it was."""
    from strideframe.operators.frames import derive_episodes

    meta = f"{snapshot_dir}/meta"
    found, label = _first_readable(
        spark,
        [
            ("meta/episodes", read_parquet_tree, f"{meta}/episodes"),
            ("meta/episodes.jsonl", read_json_lines, f"{meta}/episodes.jsonl"),
        ],
    )
    if found is None:
        return normalize_columns(derive_episodes(frames)), "derived_from_frames"
    return found, label


def read_tasks(spark: SparkSession, snapshot_dir: str) -> tuple[DataFrame | None, str | None]:
    meta = f"{snapshot_dir}/meta"
    return _first_readable(
        spark,
        [
            ("meta/tasks.parquet", read_parquet_tree, f"{meta}/tasks.parquet"),
            ("meta/tasks.jsonl", read_json_lines, f"{meta}/tasks.jsonl"),
        ],
    )


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path`` relative to ``root`` and ``length`` in bytes; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        listing = reader.load(root).select("path", "length")
    except AnalysisException as error:
        if _is_missing(error):
            return literal_table(spark, [], LISTING_SCHEMA)
        raise
    if "://" not in root and ":/" not in root:
        root = os.path.abspath(root)
    anchor = root.split("://", 1)[-1].rstrip("/") + "/"
    # the first occurrence: below it the same names may come again
    start = F.locate(anchor, F.col("path")) + len(anchor)
    return listing.select(F.substring("path", start, F.length("path")).alias("path"), F.col("length").cast("long"))


def file_row_counts(frames: DataFrame) -> DataFrame:
    """Rows and bytes of every file behind a file-based DataFrame."""
    meta = F.col("_metadata")
    return (
        frames.select(meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size"))
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
    )


def read_document(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON document; an empty dict when it does not exist."""
    try:
        lines = spark.read.option("wholetext", True).text(path).collect()
    except AnalysisException as error:
        if _is_missing(error):
            return {}
        raise
    return json.loads(lines[0].value) if lines else {}


def write_document(spark: SparkSession, path: str, document: dict[str, Any]) -> None:
    text = json.dumps(document, ensure_ascii=False, sort_keys=True, default=str)
    literal_table(spark, [(text,)], "value string").write.mode("overwrite").text(path)
