"""Observation and action windows around stride anchors.

A range join of anchors and frames meets every anchor of an episode with every frame of it. Anchors sit on
multiples of the stride, so the anchors whose window holds a frame can be computed from the frame number instead.
Frames go to cells of neighbouring anchors (with the few frames a cell shares with the next one copied), each cell
is sorted once to find every frame's predecessor, and the statistics of both windows are one aggregate in the same
partitioning. A long episode is many cells, and exact copies of a frame collapse before the first shuffle.

All rows of one frame number lie in the same windows, so a frame number with very many different timestamps is summed up
first: its timestamps are cut into pieces at quantiles, each piece is sorted by itself, and the pieces' edges and steps are
put together in order. What enters its cell is one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.config import WindowSpec
from strideframe.functions.integers import floor_div_sql
from strideframe.sources import scratch

# suffix of a window statistic -> its type
STATISTICS = {
    "rows": "long",
    "actual_start_frame": "long",
    "actual_end_frame": "long",
    "start_timestamp": "double",
    "end_timestamp": "double",
    "duration_seconds": "double",
    "max_timestamp_gap_seconds": "double",
    "min_timestamp_gap_seconds": "double",
}


def statistic_names(role: str) -> list[str]:
    return [f"{role}_{suffix}" for suffix in STATISTICS]


@dataclass(frozen=True)
class AnchorGrid:
    """Anchors at the multiples of ``stride`` and the windows around them."""

    stride: int
    window: WindowSpec
    anchors_per_cell: int = 64

    @property
    def first_anchor(self) -> int:
        """Smallest anchor number whose observation window starts at frame 0 or later."""
        return -(self.window.observation_start_offset // self.stride)

    @property
    def hull(self) -> tuple[int, int]:
        """Offsets from the start of the first window to the end of the last; empty windows do not count."""
        spans = [(low, high) for low, high in self.window.roles.values() if low <= high]
        return (min(s[0] for s in spans), max(s[1] for s in spans)) if spans else (0, -1)

    def numbers(self) -> tuple[str, str]:
        """First and last anchor number (anchor / stride) whose hull holds ``frame``."""
        low, high = self.hull
        first = f"greatest({floor_div_sql(f'frame + {self.stride - 1 - high}', self.stride)}, {self.first_anchor}L)"
        return first, floor_div_sql(f"frame - ({low})", self.stride)

    def inside(self, role: str) -> str:
        """True when ``frame`` lies in the role's window of ``anchor``."""
        low, high = self.window.roles[role]
        return f"frame - anchor between {low} and {high}"


#: a frame number with more rows than this is summed up before it enters a cell
HOT_ROWS = 1_000_000
#: frame numbers are counted together in these before they are counted by themselves
HOT_BUCKETS = 16_384
PIECES = 64
# a row's own part of a statistic: edges in time order, extremes, and largest and smallest step between its own rows
_SUMMARY = ["enter", "leave", "low", "high", "wide", "tight"]


def frame_summaries(frames: DataFrame, pieces: int = PIECES) -> DataFrame:
    """``episode, frame, copies`` and ``_SUMMARY`` of every frame number, whatever the number of its timestamps.

    A row without timestamp comes first: it has no step to or from it. ``enter`` is NULL then.
    """
    distinct = frames.groupBy("episode", "frame", "ts").agg(F.expr("count(1) as copies"))
    shares = ", ".join(f"{k / pieces!r}D" for k in range(1, pieces)) or "0.5D"
    bounds = distinct.groupBy("episode", "frame").agg(F.expr(f"percentile_approx(ts, array({shares}), 10000) as bounds"))
    cut = distinct.join(bounds, ["episode", "frame"]).selectExpr(
        "episode", "frame", "ts", "copies", "case when ts is null then -1 else size(filter(bounds, b -> b < ts)) end as piece"
    )
    inside = cut.selectExpr(
        "*", "ts - lag(ts) over (partition by episode, frame, piece order by ts) as step",
        "case when copies > 1 and ts is not null then 0D end as still",
    )
    per_piece = inside.groupBy("episode", "frame", "piece").agg(
        F.expr("sum(copies) as copies"), F.expr("min(ts) as low"), F.expr("max(ts) as high"),
        F.expr("max(greatest(step, still)) as wide"), F.expr("min(least(step, still)) as tight"),
    )
    across = per_piece.selectExpr("*", "low - lag(high) over (partition by episode, frame order by piece) as step")
    return across.groupBy("episode", "frame").agg(
        F.expr("sum(copies) as copies"), F.expr("case when min(piece) >= 0 then min(low) end as enter"), F.expr("max(high) as leave"),
        F.expr("min(low) as low"), F.expr("max(high) as high"), F.expr("max(greatest(wide, step)) as wide"),
        F.expr("min(least(tight, step)) as tight"),
    )


def hot_frames(frames: DataFrame, least: int = HOT_ROWS, pieces: int = PIECES) -> DataFrame | None:
    """The stored summaries of frame numbers with more than ``least`` rows; None when there are none.

    A table of no more than ``least`` rows cannot have any, which Parquet footers tell.
    """
    if frames.count() <= least:
        return None
    bucket = F.pmod(F.xxhash64("episode", "frame"), F.lit(HOT_BUCKETS))
    keyed = frames.where("episode is not null and frame is not null").select("episode", "frame", bucket.alias("bucket"))
    # a number with very many rows lies in a bucket with at least as many, so only the rows of such buckets are counted by number
    sizes = keyed.groupBy("bucket").agg(F.expr("count(1) as n"))
    full = scratch.store(sizes.where(F.col("n") > least).select("bucket"), "full-buckets")
    if full.isEmpty():
        return None
    counts = keyed.join(full, "bucket", "left_semi").groupBy("episode", "frame").agg(F.expr("count(1) as n"))
    keys = scratch.store(counts.where(F.col("n") > least).select("episode", "frame"), "hot-frames")
    if keys.isEmpty():
        return None
    return scratch.store(frame_summaries(frames.join(keys, ["episode", "frame"], "left_semi"), pieces), "hot-summaries")


def window_frames(frames: DataFrame, grid: AnchorGrid, hot: DataFrame | None = None) -> DataFrame:
    """One row per anchor and distinct (frame, timestamp) near it: ``episode, cell, anchor, frame, ts, copies``, whether
    the frame is in each role's window (``in_<role>``), the row before it in time order (``prev_frame, prev_ts``) and its
    ``_SUMMARY``. Frame numbers with a ``hot`` summary are one row.
    """
    first, last = grid.numbers()
    near = frames.selectExpr("episode", "frame", "ts").where(f"episode is not null and {first} <= {last}")
    # exact copies of a frame become one row before anything is shuffled
    distinct = near.groupBy("episode", "frame", "ts").agg(F.expr("count(1) as copies"))
    # copies of one frame are zero steps apart
    still = "case when copies > 1 and ts is not null then 0D end"
    single = [f"{value} as {name}" for value, name in zip(["ts"] * 4 + [still] * 2, _SUMMARY)]
    if hot is not None:
        summed = hot.selectExpr("episode", "frame", "enter as ts", "copies", *_SUMMARY).where(f"{first} <= {last}")
        others = distinct.join(hot.select("episode", "frame"), ["episode", "frame"], "left_anti")
        distinct = others.selectExpr("episode", "frame", "ts", "copies", *single).union(summed)
    size = grid.anchors_per_cell
    cells = f"sequence({floor_div_sql(first, size)}, {floor_div_sql(last, size)})"
    in_cells = distinct.selectExpr("*", f"explode({cells}) as cell")
    before = "over (partition by episode, cell order by frame, ts)"
    leave = "ts" if hot is None else "leave"
    stepped = in_cells.selectExpr("*", f"lag(frame) {before} as prev_frame", f"lag({leave}) {before} as prev_ts")
    # what follows from the row itself is put to it here, after the shuffle into cells
    summary = single if hot is None else _SUMMARY
    kept = ["episode", "cell", "frame", "ts", "copies", "prev_frame", "prev_ts"]
    numbers = f"sequence(greatest({first}, cell * {size}), least({last}, cell * {size} + {size - 1}))"
    spread = stepped.selectExpr(*kept, *summary, f"explode({numbers}) as number")
    spread = spread.selectExpr(*kept, *_SUMMARY, f"number * {grid.stride} as anchor")
    return spread.selectExpr("*", *[f"{grid.inside(role)} as in_{role}" for role in grid.window.roles])


def step_in_window(grid: AnchorGrid, role: str) -> str:
    """Time since the row before, NULL when that row is not in the same window."""
    low, _ = grid.window.roles[role]
    return f"case when in_{role} and prev_frame >= anchor + ({low}) then enter - prev_ts end"


def anchor_statistics(frames: DataFrame, grid: AnchorGrid, hot: DataFrame | None = None) -> DataFrame:
    """Statistics of both windows of every (episode, anchor) with at least one frame near it.

    ``hot`` are the summaries of :func:`hot_frames`, if there are any.
    """
    roles = list(grid.window.roles)
    rows = window_frames(frames, grid, hot).selectExpr(
        "*", *[f"{step_in_window(grid, role)} as step_{role}" for role in roles]
    )
    measures = []
    for role in roles:
        low, high = f"min(case when in_{role} then low end)", f"max(case when in_{role} then high end)"
        values = [
            f"sum(case when in_{role} then copies end)",
            f"min(case when in_{role} then frame end)",
            f"max(case when in_{role} then frame end)",
            low,
            high,
            f"{high} - {low}",
            f"max(greatest(abs(step_{role}), case when in_{role} then wide end))",
            f"min(least(step_{role}, case when in_{role} then tight end))",
        ]
        measures += [F.expr(f"{value} as {name}") for value, name in zip(values, statistic_names(role))]
    # the cell is kept in the keys: it is where the rows already are, so this adds no shuffle
    return rows.groupBy("episode", "cell", "anchor").agg(*measures).drop("cell")


def attach_statistics(anchors: DataFrame, frames: DataFrame, grid: AnchorGrid) -> DataFrame:
    """Anchors (``episode, task, anchor_frame, ...``) with the statistics of their windows.

    Statistics belong to a sample id, and a repeated anchor row repeats the frames of its window; ``repeats`` puts
    that factor back without a second pass over the frames. It is empty on clean data.
    """
    repeats = anchors.groupBy("episode", "task", "anchor_frame").agg(F.expr("count(1) as times")).where("times > 1")
    stats = anchor_statistics(frames, grid, hot_frames(frames))
    joined = (
        anchors.alias("a")
        .join(stats.alias("s"), F.expr("a.episode = s.episode and a.anchor_frame = s.anchor"), "left")
        .join(
            repeats.alias("r"),
            F.expr("a.episode = r.episode and a.anchor_frame = r.anchor_frame and a.task <=> r.task"),
            "left",
        )
    )
    columns = [f"a.{name}" for name in anchors.columns]
    for role in grid.window.roles:
        still = f"case when times > 1 and {role}_start_timestamp is not null then 0D end"
        adjusted = {
            f"{role}_rows": f"coalesce({role}_rows, 0L) * coalesce(times, 1L)",
            f"{role}_max_timestamp_gap_seconds": f"greatest({role}_max_timestamp_gap_seconds, {still})",
            f"{role}_min_timestamp_gap_seconds": f"least({role}_min_timestamp_gap_seconds, {still})",
        }
        columns += [f"{adjusted.get(name, name)} as {name}" for name in statistic_names(role)]
    return joined.selectExpr(*columns)


def window_gaps(anchors: DataFrame, frames: DataFrame, grid: AnchorGrid) -> DataFrame:
    """Every frame of every sample's windows with the step in time before it; copies are listed one by one."""
    samples = anchors.selectExpr("sample_id", "episode", "anchor_frame as anchor").distinct()
    # a frame may lie in both windows of an anchor; both entries come from the one sorted row
    entries = [
        f"case when in_{role} then named_struct('role', '{role}', 'step', {step_in_window(grid, role)}) end" for role in grid.window.roles
    ]
    listed = (
        window_frames(frames, grid)
        .selectExpr("episode", "anchor", "frame", "ts", "copies", f"inline(filter(array({', '.join(entries)}), x -> x is not null))")
        .selectExpr("*", "explode(sequence(1, cast(copies as int))) as copy")
    )
    gap = "case when copy = 1 then step when ts is not null then 0D end"
    return samples.join(listed, ["episode", "anchor"]).selectExpr(
        "sample_id",
        "role",
        "frame as window_frame",
        "ts as window_timestamp",
        f"{gap} as timestamp_gap_seconds",
        f"abs({gap}) as abs_timestamp_gap_seconds",
    )
