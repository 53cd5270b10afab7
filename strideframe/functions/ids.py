"""Identifier columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def task_key(task: Column) -> Column:
    """``task_<n>``; NULL for a NULL task, so that ids built from it leave the part out."""
    return F.concat(F.lit("task_"), task.cast("string"))


def sample_key(episode: Column, instruction: Column, frame: Column) -> Column:
    return F.concat_ws("_", F.lit("sample"), episode.cast("string"), instruction, frame.cast("string"))


def instruction_key(seed_parts: list[Column]) -> Column:
    digest = F.sha2(F.concat_ws("||", *seed_parts), 256)
    return F.concat(F.lit("inst_"), F.substring(digest, 1, 16))
