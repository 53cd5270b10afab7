"""Late reading of wide rows by their place."""

import pytest
from pyspark.sql import functions as F

from strideframe.operators import locators as L


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "t")
    rows = spark.range(0, 5000, 1, 7).select("id", (F.col("id") % 13).alias("group"), F.array(F.col("id") * 2).alias("wide"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _places(table, condition):
    from strideframe.sources import scratch

    return scratch.store(L.placed(table.select("id", "group")).where(condition).select(L.FILE, L.ROW), "places")


@pytest.mark.parametrize("most", [None, 100, 7])
@pytest.mark.parametrize("condition", ["group = 3", "id % 64 = 63 or id < 2", "true", "false"])
def test_rows_at_their_places(table, condition, most):
    if most == 7 and condition == "true":
        return  # hundreds of batches of one file
    got = L.rows_at(L.placed(table), _places(table, condition), most).select("id", "wide")
    assert sorted((r["id"], r["wide"]) for r in got.collect()) == [
        (r["id"], [r["id"] * 2]) for r in table.where(condition).orderBy("id").collect()
    ]


def test_repeated_places_give_one_row(table):
    places = _places(table, "id = 5").union(_places(table, "id = 5"))
    assert L.rows_at(L.placed(table), places).count() == 1


def test_wide_rows_enter_no_exchange(spark, table):
    """The only exchange of the plan holds the words of the chosen places."""
    found = L.rows_at(L.placed(table), _places(table, "group = 3"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    wide = next(line for line in plan.splitlines() if "Scan parquet" in line and "wide" in line)
    above = plan.splitlines()[: plan.splitlines().index(wide)]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    level, path = depth(wide), []
    for line in reversed(above):
        if depth(line) < level:
            level, path = depth(line), [*path, line]
    assert not [line for line in path if "Exchange" in line and "Broadcast" not in line]


def test_batches_read_their_own_files_only(table):
    """A batch is a condition on the path alone, by which Spark leaves files out of the scan."""
    placed = L.placed(table)
    files = {r[L.FILE] for r in placed.select(L.FILE).distinct().collect()}
    one = placed.where(F.pmod(F.col(L.FILE), F.lit(3)) == 1)
    rows = one.collect()
    assert {r[L.FILE] for r in rows} == {f for f in files if f % 3 == 1}
    metrics = one._jdf.queryExecution().executedPlan()
    while metrics.children().size():
        metrics = metrics.children().apply(0)
    read = metrics.metrics().apply("numFiles").value()
    assert read == len({f for f in files if f % 3 == 1}) < len(files)


def test_a_table_without_files_is_stored_first(spark):
    made = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    placed = L.placed(made)
    assert sorted(r["x"] for r in placed.collect()) == ["a", "b"] and placed.columns == ["id", "x", L.FILE, L.ROW]
