"""Video paths as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARD_PATTERN = "videos/%s/chunk-%03d/file-%03d.mp4"  # fixed layout of numbered shards
TEMPLATE_FIELDS = frozenset({"episode_chunk", "episode_index", "video_key"})
DEFAULT_CHUNK_SIZE = 1000


def shard_path(video_key: Column, chunk_index: Column, file_index: Column) -> Column:
    path = F.format_string(SHARD_PATTERN, video_key, chunk_index.cast("long"), file_index.cast("long"))
    return F.when(chunk_index.isNotNull() & file_index.isNotNull(), path)


def template_fields(template: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(template) if name is not None]


def template_path(template: str, values: dict[str, Column]) -> Column:
    """Render a ``{name}`` / ``{name:03d}`` template with columns."""
    pattern, args = [], []
    for literal, name, spec, _ in string.Formatter().parse(template):
        pattern.append(literal.replace("%", "%%"))
        if name is None:
            continue
        if name not in values:
            raise ValueError(f"unknown field {name!r} in video path template {template!r}")
        pattern.append("%" + (spec if spec.endswith("d") else spec + "s"))
        args.append(values[name])
    return F.format_string("".join(pattern), *args)
