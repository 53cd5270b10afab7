"""From manifest rows back to frames and videos, for a whole manifest at once.

Manifest rows that differ only in their instruction share a window. The long form matches frames with distinct windows
on a small frame cell: a few comparisons per frame for windows of any width, and no episode is a single join key. The
nested form gathers frames once into cells as wide as the windows and cuts every window out of one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.columns import col, first_present
from strideframe.functions.integers import floor_div
from strideframe.operators.locators import FILE, ROW, placed, rows_at
from strideframe.operators.manifest import EPISODE_NAMES, FRAME_NAMES
from strideframe.operators.video import refs_by_episode
from strideframe.sources import scratch

CELL = 16
ROLES = ("observation", "action")
WINDOW_KEY = ["episode_id", "role", "first", "last"]
_BASE = ("episode_index", "frame_index", "timestamp")


def observation_columns(names: list[str]) -> list[str]:
    return [n for n in names if n in _BASE or n.startswith("observation.")]


def action_columns(names: list[str]) -> list[str]:
    return [n for n in names if n in _BASE or n == "action" or n.startswith("action.")]


def frame_keys(frames: DataFrame) -> tuple[str, str]:
    episode, frame = first_present(frames.columns, EPISODE_NAMES), first_present(frames.columns, FRAME_NAMES)
    if episode is None or frame is None:
        raise ValueError("frames need an episode and a frame column")
    return episode, frame


def role_spans() -> Column:
    """Generates ``role, first, last`` for both windows of a manifest row."""
    spans = [
        F.struct(
            F.lit(role).alias("role"),
            F.col(f"{role}_start_frame").cast("long").alias("first"),
            F.col(f"{role}_end_frame").cast("long").alias("last"),
        )
        for role in ROLES
    ]
    return F.inline(F.array(*spans))


def manifest_windows(manifest: DataFrame) -> DataFrame:
    """Distinct ``episode_id, role, first, last``."""
    return manifest.select("episode_id", role_spans()).distinct()


def episode_key(frames: DataFrame, episode: str) -> Column:
    """Manifest ids are text: compare as numbers when the frames number their episodes."""
    numeric = isinstance(frames.schema[episode].dataType, T.IntegralType)
    return F.col("episode_id").try_cast("long") if numeric else F.col("episode_id")


def match_windows(windows: DataFrame, frames: DataFrame, payload: list[Column]) -> DataFrame:
    """Windows (``episode_id, first, last, ...``) joined with their frames: adds ``frame`` and the payload columns."""
    episode, frame = frame_keys(frames)
    rows = frames.select(col(episode).alias("_episode"), col(frame).cast("long").alias("frame"), *payload)
    rows = rows.withColumn("_cell", floor_div("frame", CELL))
    cells = F.sequence(floor_div("first", CELL), floor_div("last", CELL))
    spread = windows.where("first <= last").select(
        "*", episode_key(frames, episode).alias("_wanted"), F.explode(cells).alias("_window_cell")
    )
    on = (
        (F.col("_wanted") == F.col("_episode"))
        & (F.col("_window_cell") == F.col("_cell"))
        & F.col("frame").between(F.col("first"), F.col("last"))
    )
    return spread.join(rows, on).drop("_wanted", "_window_cell", "_episode", "_cell")


def resolved_frames(manifest: DataFrame, frames: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form: one row per sample, role and frame, with the frame's columns as a ``record``.

    This form has no arrays, so its row size does not depend on the window.
    """
    record = F.struct(*[col(n) for n in (columns or frames.columns)]).alias("record")
    matched = match_windows(manifest_windows(manifest), frames, [record])
    samples = manifest.select("sample_id", "episode_id", role_spans())
    return samples.join(matched, WINDOW_KEY).select("sample_id", "role", "frame", "record")


def _hull(side: str) -> Column:
    """First (``start``) or last (``end``) frame over both windows of a manifest row; empty windows do not count."""
    bounds = [
        F.when(F.col(f"{role}_start_frame") <= F.col(f"{role}_end_frame"), F.col(f"{role}_{side}_frame").cast("long")) for role in ROLES
    ]
    return F.least(*bounds) if side == "start" else F.greatest(*bounds)


def with_cell(manifest: DataFrame) -> DataFrame:
    """``manifest`` with ``_width, _cell``: the cell of ``_width`` frames (a power of two, at least as wide as both windows
    together) in which its windows start. They end in that cell or in the next one. Null when both windows are empty."""
    spanned = manifest.withColumns({"_low": _hull("start"), "_high": _hull("end")})
    sized = spanned.withColumn("_width", F.expr("shiftleft(1L, length(bin(_high - _low)))"))
    return sized.withColumn("_cell", F.expr("(_low - pmod(_low, _width)) div _width")).drop("_low", "_high")


def frame_cells(frames: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """``_episode, _width, _cell, _items``: the frames of each ``wanted`` cell and of the one after it, once, in order.

    ``wanted`` has ``_wanted, _width, _cell``. A frame goes to two cells of each width that some window needs (a power of
    two, so there are 63 at most), and to none that no window starts in.
    """
    episode, frame = frame_keys(frames)
    wanted = wanted.where("_cell is not null").distinct()
    widths = sorted(r["_width"] for r in wanted.select("_width").distinct().collect())
    if not widths:
        widths = [1]
    homes = []
    for width in widths:
        home = floor_div("frame", width)
        homes += [F.struct(F.lit(width).cast("long").alias("_width"), (home - back).alias("_cell")) for back in (0, 1)]
    record = F.struct(*[col(n) for n in names]).alias("record")
    rows = frames.select(col(episode).alias("_episode"), col(frame).cast("long").alias("frame"), record)
    spread = rows.select("_episode", "frame", "record", F.inline(F.array(*homes)))
    needed = wanted.select(F.col("_wanted").alias("_episode"), "_width", "_cell")
    kept = spread.join(needed, ["_episode", "_width", "_cell"], "left_semi")
    items = F.array_sort(F.collect_list(F.struct("frame", "record"))).alias("_items")
    return kept.groupBy("_episode", "_width", "_cell").agg(items)


def _slice(items: str, first: Column, last: Column) -> Column:
    return F.filter(items, lambda x: x["frame"].between(first, last))


def _fields(records: Column, names: list[str], inner: str | None = None) -> Column:
    """The named fields of each record (of the field ``inner`` of each)."""
    return F.transform(records, lambda x: F.struct(*[(x[inner] if inner else x)[n].alias(n) for n in names]))


def resolve_samples(
    manifest: DataFrame, frames: DataFrame, refs: DataFrame | None = None, raw: bool = False
) -> DataFrame:
    """One nested row per sample: instruction, both windows with their records, video references.

    Observation and action records hold their own columns only, or all frame columns when ``raw``. Frames are gathered
    once into cells; both windows of a sample are slices of one cell, so no window is collected by itself.
    """
    picked = {"observation": observation_columns, "action": action_columns}
    columns = {role: frames.columns if raw else picked[role](frames.columns) for role in ROLES}
    used = [n for n in frames.columns if any(n in names for names in columns.values())]
    episode, _ = frame_keys(frames)
    placed_windows = with_cell(manifest).withColumn("_wanted", episode_key(frames, episode))
    cells = frame_cells(frames, placed_windows.select("_wanted", "_width", "_cell"), used)
    cells = cells.withColumnsRenamed({"_width": "_own_width", "_cell": "_own_cell"})
    on = (
        (F.col("_wanted") == F.col("_episode"))
        & (F.col("_width") == F.col("_own_width"))
        & (F.col("_cell") == F.col("_own_cell"))
    )
    result = placed_windows.join(cells, on, "left")
    for role, names in columns.items():
        start, end = F.col(f"{role}_start_frame"), F.col(f"{role}_end_frame")
        found = F.coalesce(_fields(_slice("_items", start, end), names, "record"), F.array())
        result = result.withColumn(
            role,
            F.struct(
                F.array(start, end).alias("frame_range"),
                F.size(found).cast("long").alias("rows"),
                F.array(*[F.lit(n) for n in names]).alias("columns"),
                found.alias("records"),
            ),
        )
    return _with_videos(result, refs).select("sample_id", "episode_id", _instruction(), *ROLES, "video_refs")


def _instruction() -> Column:
    return F.struct(F.col("instruction_id"), F.col("instruction_text").alias("text")).alias("instruction")


def _with_videos(samples: DataFrame, refs: DataFrame | None) -> DataFrame:
    """``samples`` with ``video_refs``; NULL where an episode has none, empty without any references."""
    if refs is None:
        empty = F.array().cast("array<struct<video_key:string,path:string,exists:boolean>>")
        return samples.withColumn("video_refs", empty)
    return samples.join(refs_by_episode(refs), "episode_id", "left")


def preview_samples(
    manifest: DataFrame, frames: DataFrame, refs: DataFrame | None = None, records: int = 1, raw: bool = False
) -> DataFrame:
    """What ``preview(resolve_samples(...))`` gives, without resolving whole windows.

    The first ``records`` frames of each window are chosen on the key columns, then only those rows are read whole.
    """
    picked = {"observation": observation_columns, "action": action_columns}
    columns = {role: frames.columns if raw else picked[role](frames.columns) for role in ROLES}
    used = [n for n in frames.columns if any(n in names for names in columns.values())]
    stored = placed(frames)
    episode, frame = frame_keys(frames)
    matched = match_windows(manifest_windows(manifest), stored.select(episode, frame, FILE, ROW), [F.col(FILE), F.col(ROW)])
    order = Window.partitionBy(*WINDOW_KEY).orderBy("frame", FILE, ROW)
    numbered = matched.withColumn("_number", F.row_number().over(order)).where(F.col("_number") <= records)
    chosen = scratch.store(numbered.select(*WINDOW_KEY, "_number", FILE, ROW), "previewed")
    wide = stored.select(FILE, ROW, F.struct(*[col(n) for n in used]).alias("record"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_number", "record"))), lambda x: x["record"])
    first = chosen.join(rows_at(wide, chosen.select(FILE, ROW)), [FILE, ROW]).groupBy(*WINDOW_KEY).agg(listed.alias("_records"))
    counts = matched.groupBy(*WINDOW_KEY).agg(F.count(F.lit(1)).alias("_rows"))
    windows = counts.join(first, WINDOW_KEY, "left")
    result = manifest
    for role, names in columns.items():
        own = windows.where(F.col("role") == role).select(
            F.col("episode_id").alias("_episode"), F.col("first").alias("_first"), F.col("last").alias("_last"),
            F.col("_rows").alias(f"_{role}_rows"), F.col("_records").alias(f"_{role}_records"),
        )
        start, end = F.col(f"{role}_start_frame"), F.col(f"{role}_end_frame")
        on = (F.col("episode_id") == F.col("_episode")) & (start == F.col("_first")) & (end == F.col("_last"))
        short = _fields(F.col(f"_{role}_records"), names)
        result = result.join(own, on, "left").drop("_episode", "_first", "_last").withColumn(
            role,
            F.struct(
                F.array(start, end).alias("frame_range"),
                F.coalesce(f"_{role}_rows", F.lit(0).cast("long")).alias("rows"),
                F.array(*[F.lit(n) for n in names]).alias("columns"),
                F.coalesce(short, F.array()).alias("preview_records"),
            ),
        )
    missing = F.size(F.filter("video_refs", lambda ref: ~ref["exists"])).cast("long")
    return _with_videos(result, refs).select(
        "sample_id", "episode_id", _instruction(), *ROLES, "video_refs", missing.alias("missing_video_count")
    )


def preview(resolved: DataFrame, records: int = 1) -> DataFrame:
    """Resolved samples with the first few records of each window and the number of missing videos."""

    def short(role: str) -> Column:
        kept = ["frame_range", "rows", "columns"]
        fields = [F.col(f"{role}.{n}").alias(n) for n in kept]
        return F.struct(*fields, F.slice(F.col(f"{role}.records"), 1, records).alias("preview_records")).alias(role)

    missing = F.size(F.filter("video_refs", lambda ref: ~ref["exists"])).cast("long")
    return resolved.select(
        "sample_id", "episode_id", "instruction", *[short(r) for r in ROLES], "video_refs",
        missing.alias("missing_video_count"),
    )
