"""Which files a set of episodes needs, and how large they are."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.config import EpisodeFilter
from strideframe.functions.columns import col, first_present
from strideframe.operators.frames import listed_episodes
from strideframe.operators.manifest import EPISODE_NAMES
from strideframe.operators.video import _shards, shard_keys
from strideframe.sources.small import literal_table

BASE_PATTERNS = ("README.md", "meta/**", "data/**")


def _episode_column(episodes: DataFrame) -> str:
    name = first_present(episodes.columns, EPISODE_NAMES)
    if name is None:
        raise ValueError(f"episode metadata has none of the columns {EPISODE_NAMES}")
    return name


def select_episodes(episodes: DataFrame, chosen: EpisodeFilter) -> DataFrame:
    """Metadata of the listed episodes, or of the first ``count`` available ones from ``start``."""
    name = _episode_column(episodes)
    episode = col(name).cast("long")
    if chosen.episodes:
        return episodes.join(listed_episodes(episodes.sparkSession, chosen), episode == F.col("_listed"), "left_semi")
    if chosen.count <= 0:
        raise ValueError("name episodes or a positive episode count")
    first = (
        episodes.where(episode >= chosen.start)
        .select(episode.alias("_chosen"))
        .distinct()
        .orderBy("_chosen")
        .limit(chosen.count)
    )
    return episodes.join(first, episode == F.col("_chosen"), "left_semi")


def shard_paths(episodes: DataFrame, video_keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct video shard paths of the episodes, of all cameras or some, in path order."""
    keys = [key for key in shard_keys(episodes.columns) if not video_keys or key in video_keys]
    refs = episodes.select(F.explode(_shards(episodes.columns, keys)).alias("ref"))
    return refs.select(F.col("ref.path").alias("path")).distinct().orderBy("path")


def plan_patterns(paths: DataFrame, base: Sequence[str] = BASE_PATTERNS) -> DataFrame:
    """Base patterns and shard paths together, each once."""
    fixed = literal_table(paths.sparkSession, [(p,) for p in base], "pattern string")
    return fixed.union(paths.select(F.col("path").alias("pattern"))).distinct()


def pattern_sizes(patterns: DataFrame, files: DataFrame) -> DataFrame:
    """``pattern, files, bytes``; a pattern with a star stands for every path that starts like it.

    A file is listed under its path and under its beginnings of the lengths that starred patterns have (they are given by
    hand, so there are few), and files are added up under these keys before patterns look up theirs. So every pattern is
    one equal key, a folder that holds most files is no hot one, and the patterns are planned once.
    """
    starred = F.col("pattern").contains("*")
    key = F.substring_index("pattern", "*", 1)
    lengths = sorted(r["n"] for r in patterns.where(starred).select(F.length(key).alias("n")).distinct().collect())
    path = F.col("path")
    keys = [F.struct(F.lit(False).alias("_prefix"), path.alias("_key"))]
    keys += [F.struct(F.lit(True).alias("_prefix"), F.when(F.length(path) >= n, F.left(path, F.lit(n))).alias("_key")) for n in lengths]
    listed = files.select(F.col("length").alias("_length"), F.inline(F.array(*keys))).where("_key is not null")
    totals = listed.groupBy("_prefix", "_key").agg(F.count(F.lit(1)).alias("_files"), F.sum("_length").alias("bytes"))
    on = (starred == F.col("_prefix")) & (key == F.col("_key"))
    return patterns.select("pattern").join(totals, on, "left").select(
        "pattern", F.coalesce("_files", F.lit(0)).alias("files"), "bytes"
    )


def plan_size(sizes: DataFrame) -> DataFrame:
    """One row: the total, NULL as soon as one pattern matched nothing, and how many did."""
    unknown = F.count_if(F.col("files") == 0)
    return sizes.agg(
        F.count(F.lit(1)).alias("patterns"),
        unknown.alias("patterns_without_size"),
        F.when(unknown == 0, F.sum("bytes")).alias("estimated_bytes"),
    )


def shard_plan(
    episodes: DataFrame,
    files: DataFrame,
    chosen: EpisodeFilter,
    video_keys: Sequence[str] | None = None,
    base: Sequence[str] = BASE_PATTERNS,
    max_gib: float | None = None,
) -> tuple[DataFrame, dict[str, Any]]:
    """Pattern sizes of the chosen episodes and the plan's totals; an error when nothing matches or it is too large."""
    kept = select_episodes(episodes, chosen)
    if kept.isEmpty():
        raise ValueError("no episode metadata matches the chosen episodes")
    sizes = pattern_sizes(plan_patterns(shard_paths(kept, video_keys), base), files)
    totals = plan_size(sizes).first().asDict()
    check_budget(totals["estimated_bytes"], max_gib)
    return sizes, totals


def check_budget(estimated_bytes: int | None, max_gib: float | None) -> None:
    """An unknown size passes: there is nothing to compare."""
    if estimated_bytes is None or max_gib is None:
        return
    limit = int(float(max_gib) * 1024**3)
    if estimated_bytes > limit:
        raise ValueError(f"plan needs {estimated_bytes} bytes, the budget is {limit}")
