"""Every registered query against its SQL form, and the known totals of the fixtures."""

import oracle
import pytest
from paths import TESTDATA

import __spark_entry__ as entry_points
from catalog import fixtures as X
from catalog import tables
from catalog.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert oracle.compare(duck, ORACLES[name], df) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 41
    assert df.count() == 191
    assert entry_points.queries().keys() >= entry_points.oracle_sql().keys()


GOLDEN = {
    "sf0.001": {
        "frames": 1000,
        "fe": {"ok": 52, "missing_window_rows": 125, "non_monotonic_timestamp": 6, "timestamp_gap_exceeded": 8},
        "fl": {"ok": 106, "missing_window_rows": 6, "timestamp_gap_exceeded": 84},
        "annotations": 68,
        "manifest": 87,
        "episode_manifest": 248,
    },
    "sf0.01": {
        "frames": 10000,
        "fe": {"ok": 551, "missing_window_rows": 1251, "non_monotonic_timestamp": 45, "timestamp_gap_exceeded": 62},
        "fl": {"ok": 1062, "missing_window_rows": 32, "timestamp_gap_exceeded": 856},
        "annotations": 620,
        "manifest": 865,
        "episode_manifest": 2364,
    },
}


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_golden_totals(spark, sf):
    want, folder = GOLDEN[sf], f"{TESTDATA}/{sf}"
    assert tables.get(spark, folder, "frames").count() == want["frames"]
    for query, key in (("sync_status_counts", "fe"), ("sync_status_counts_lines", "fl")):
        counts = {r["sync_status"]: r["samples"] for r in QUERIES[query](spark, folder).collect()}
        assert counts == want[key]
    assert tables.get(spark, folder, "annotations").count() == want["annotations"]
    assert tables.get(spark, folder, "manifest").count() == want["manifest"]
    assert QUERIES["manifest_episode_join"](spark, folder).count() == want["episode_manifest"]


def test_every_fixture_rule_is_an_annotation_rule():
    assert {r.match_text for r in X.RULES} <= {text for _, text in X.TASKS}
