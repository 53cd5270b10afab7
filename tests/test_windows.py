"""Window statistics against a brute-force range join in plain Python, on dirty random frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strideframe.config import FrameColumns, SyncConfig, WindowSpec
from strideframe.operators.frames import select_frames
from strideframe.operators.sync import anchor_samples, grid_of, synced_samples, window_statistics
from strideframe.operators.windows import AnchorGrid, STATISTICS, anchor_statistics, hot_frames, window_gaps

SCHEMA = "episode_index long, frame_index long, timestamp double, task_index long"


def brute_force(rows, stride, window):
    """sample id -> role -> statistics, by meeting every anchor with every frame."""
    samples = {}
    for e, f, _, t in rows:
        if f is None or f % stride or f + window.observation_start_offset < 0:
            continue
        parts = ["sample", e, None if t is None else f"task_{t}", f]
        sample = "_".join(str(p) for p in parts if p is not None)
        found = samples.setdefault(sample, {"observation": [], "action": []})
        for role, (low, high) in window.roles.items():
            found[role] += [
                (g, s) for d, g, s, _ in rows if e is not None and d == e and g is not None and f + low <= g <= f + high
            ]
    result = {}
    for sample, roles in samples.items():
        for role, frames in roles.items():
            frames.sort(key=lambda r: (r[0], -math.inf if r[1] is None else r[1]))
            stamps = [s for _, s in frames if s is not None]
            gaps = [
                b - a for (_, a), (_, b) in zip(frames, frames[1:]) if a is not None and b is not None
            ]
            result[sample, role] = (
                len(frames),
                min((g for g, _ in frames), default=None),
                max((g for g, _ in frames), default=None),
                min(stamps, default=None),
                max(stamps, default=None),
                max(stamps) - min(stamps) if stamps else None,
                max((abs(g) for g in gaps), default=None),
                min(gaps, default=None),
            )
    return result


def dirty_frames(seed):
    rng = random.Random(seed)
    rows = []
    for e in (0, 1, 2, 10):
        for f in range(-3, rng.choice([20, 90, 150])):
            if rng.random() < 0.15:
                continue
            task = rng.choice([0, 1, None])
            stamp = None if rng.random() < 0.03 else f * 0.5 - (20.0 if rng.random() < 0.05 else 0.0)
            rows.append((e, f, stamp, task))
            if rng.random() < 0.1:
                rows.append((e, f, stamp, task))
            if rng.random() < 0.1 and stamp is not None:
                rows.append((e, f, stamp + rng.choice([0.25, -3.0]), rng.choice([task, 1])))
    rows += [(None, 30, 1.0, 1), (None, 30, 1.0, 1), (3, None, 1.0, 1), (4, 10, 5.0, None)]
    return rows


@pytest.mark.parametrize(
    "stride, window",
    [
        (5, WindowSpec(-4, 0, 1, 4)),
        (10, WindowSpec(-10, 0, 1, 10)),
        (7, WindowSpec(-15, 3, -2, 20)),
        (4, WindowSpec(2, 5, 8, 9)),
        (6, WindowSpec(-5, -2, -20, -10)),
        (1, WindowSpec(-2, 0, 1, 2)),
        (3, WindowSpec(-1, -4, 1, 3)),
        (5, WindowSpec(0, -1, 0, -1)),
    ],
)
def test_statistics_equal_brute_force(spark, stride, window):
    rows = dirty_frames(stride)
    config = SyncConfig(columns=FrameColumns(), stride=stride, window=window)
    result = window_statistics(spark.createDataFrame(rows, SCHEMA), None, config).collect()
    got = {
        (r["sample_id"], role): tuple(r[f"{role}_{s}"] for s in STATISTICS) for r in result for role in window.roles
    }
    assert got == brute_force(rows, stride, window)


@pytest.mark.parametrize("least, pieces", [(0, 4), (0, 1), (1, 3)])
def test_summed_up_frames_give_the_same_statistics(spark, least, pieces):
    """Every frame number (or every one with several rows) summed up first, with many timestamps in some of them."""
    rng = random.Random(least * 10 + pieces)
    rows = dirty_frames(pieces)
    rows += [(1, f, rng.choice([None, round(rng.uniform(-50, 50), 1)]), rng.choice([0, 1])) for f in (10, 12, 13, 40) for _ in range(60)]
    grid = AnchorGrid(5, WindowSpec(-4, 0, 1, 4), anchors_per_cell=3)
    frames = select_frames(spark.createDataFrame(rows, SCHEMA), FrameColumns())
    hot = hot_frames(frames, least, pieces)
    plain = anchor_statistics(frames, grid)
    summed = anchor_statistics(frames, grid, hot)
    assert hot.count() >= 4 and plain.count() == summed.count()
    assert plain.exceptAll(summed).count() == 0


def test_no_frame_is_hot_in_a_small_or_even_table(spark):
    frames = select_frames(spark.createDataFrame(steady(range(30)), SCHEMA), FrameColumns())
    assert hot_frames(frames) is None and hot_frames(frames, 5) is None


def test_a_hot_frame_is_sorted_in_pieces(spark):
    """300,000 timestamps of one frame number: no task sorts more than a small part of them."""
    rows = spark.range(300_000).selectExpr("0L as episode", "5L as frame", "cast(pmod(xxhash64(id), 1000003) as double) as ts")
    rows = rows.union(spark.createDataFrame([(0, 4, -1.0), (0, 6, 2e6)], "episode long, frame long, ts double"))
    hot = hot_frames(rows, 1000)
    found = anchor_statistics(rows, AnchorGrid(5, WindowSpec(-4, 0, 1, 4)), hot).where("anchor = 5").first()
    stamps = sorted(r["ts"] for r in rows.where("frame = 5").collect())
    steps = [b - a for a, b in zip(stamps, stamps[1:])]
    assert found["observation_rows"] == 300_001 and found["action_rows"] == 1
    assert found["observation_max_timestamp_gap_seconds"] == max(*steps, stamps[0] + 1)
    assert found["observation_min_timestamp_gap_seconds"] == min(steps)
    assert found["observation_end_timestamp"] == stamps[-1]
    bounds = [stamps[len(stamps) * k // 64] for k in range(1, 64)]
    largest = max(b - a for a, b in zip([0, *[stamps.index(x) for x in bounds]], [stamps.index(x) for x in bounds] + [len(stamps)]))
    assert largest < 10_000


def test_cell_size_does_not_matter(spark):
    frames = select_frames(spark.createDataFrame(dirty_frames(1), SCHEMA), FrameColumns())
    window = WindowSpec(-9, 2, 1, 12)
    small = anchor_statistics(frames, AnchorGrid(4, window, anchors_per_cell=1))
    large = anchor_statistics(frames, AnchorGrid(4, window, anchors_per_cell=1000))
    assert small.exceptAll(large).count() == 0
    assert large.exceptAll(small).count() == 0


def test_gaps_list_every_window_row(spark):
    rows = [(0, f, f * 1.0, 0) for f in range(12)] + [(0, 7, 7.0, 0)]
    config = SyncConfig(stride=5, window=WindowSpec(-4, 0, 1, 4))
    frames = select_frames(spark.createDataFrame(rows, SCHEMA), FrameColumns())
    gaps = window_gaps(anchor_samples(frames, None, config), frames, grid_of(config))
    action = gaps.where("sample_id = 'sample_0_task_0_5' and role = 'action'").orderBy("window_frame")
    assert [r["window_frame"] for r in action.collect()] == [6, 7, 7, 8, 9]
    assert sorted(r["timestamp_gap_seconds"] or -1.0 for r in action.collect()) == [-1.0, -1.0, 1.0, 1.0, 1.0]


def synced(spark, rows, **changes):
    config = SyncConfig(**{"stride": 5, "window": WindowSpec(-4, 0, 1, 4), "max_gap_seconds": 1.0, **changes})
    df = synced_samples(spark.createDataFrame(rows, SCHEMA), None, config)
    return {r["sample_id"]: r for r in df.collect()}


def steady(frames, task=0):
    return [(0, f, f * 1.0, task) for f in frames]


def test_head_anchor_is_dropped_and_tail_is_flagged(spark):
    result = synced(spark, steady(range(13)))
    assert sorted(result) == ["sample_0_task_0_10", "sample_0_task_0_5"]
    assert result["sample_0_task_0_5"]["sync_status"] == "ok"
    tail = result["sample_0_task_0_10"]
    assert (tail["sync_status"], tail["action_rows"], tail["action_missing_rows"]) == ("missing_window_rows", 2, 2)


def test_empty_action_window(spark):
    row = synced(spark, steady(range(6)))["sample_0_task_0_5"]
    assert row["action_rows"] == 0 and row["action_start_timestamp"] is None
    assert row["max_timestamp_gap_seconds"] == 1.0


def test_single_row_window_passes_the_gap_test(spark):
    window = WindowSpec(0, 0, 1, 1)
    row = synced(spark, [(0, 5, 0.0, 0), (0, 6, 99.0, 0)], window=window)["sample_0_task_0_5"]
    assert row["sync_status"] == "ok" and row["max_timestamp_gap_seconds"] == 0.0 and row["is_timestamp_monotonic"]


def test_equal_timestamps_and_threshold_are_ok(spark):
    rows = [(0, f, float(f // 2), 0) for f in range(10)]
    row = synced(spark, rows)["sample_0_task_0_5"]
    assert row["sync_status"] == "ok" and row["min_timestamp_gap_seconds"] == 0.0
    assert row["max_timestamp_gap_seconds"] == 1.0 == row["max_allowed_timestamp_gap_seconds"]


def test_gap_and_backward_step(spark):
    late = [(0, f, f * 1.0 + (5.0 if f >= 8 else 0.0), 0) for f in range(10)]
    assert synced(spark, late)["sample_0_task_0_5"]["sync_status"] == "timestamp_gap_exceeded"
    back = [(0, f, f * 1.0 - (5.0 if f >= 8 else 0.0), 0) for f in range(10)]
    assert synced(spark, back)["sample_0_task_0_5"]["sync_status"] == "non_monotonic_timestamp"
    missing = [r for r in back if r[1] != 7]
    assert synced(spark, missing)["sample_0_task_0_5"]["sync_status"] == "missing_window_rows"


def test_duplicated_frame_is_negative_missing(spark):
    row = synced(spark, steady(range(10)) + [(0, 3, 3.0, 0)])["sample_0_task_0_5"]
    assert row["observation_missing_rows"] == -1 and row["sync_status"] == "ok" and not row["is_window_complete"]


def test_null_task_leaves_the_part_out(spark):
    row = synced(spark, steady(range(10), None))["sample_0_5"]
    assert row["instruction_id"] is None and row["instruction_text"] is None


def test_plan_has_no_cross_join_and_one_sort_per_cell(spark):
    frames = select_frames(spark.createDataFrame(steady(range(50)), SCHEMA), FrameColumns())
    plan = anchor_statistics(frames, AnchorGrid(5, WindowSpec(-4, 0, 1, 4)))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_copies_collapse_before_the_first_shuffle(spark):
    rows = spark.range(200000).select(
        F.lit(0).cast("long").alias("episode"), F.lit(5).cast("long").alias("frame"), F.lit(1.0).alias("ts")
    )
    stats = anchor_statistics(rows, AnchorGrid(5, WindowSpec(-4, 0, 1, 4))).collect()
    assert [(r["anchor"], r["observation_rows"]) for r in stats if r["observation_rows"]] == [(5, 200000)]
