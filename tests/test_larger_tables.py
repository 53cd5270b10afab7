"""Queries on tables that differ from the small test tables: more episodes, tables in part files."""

import os
import re

import duckdb
import oracle
import pytest
from pyspark.sql import functions as F
from test_build import built  # noqa: F401

from catalog import fixtures as X
from catalog.queries import ORACLES, QUERIES
from strideframe.config import WindowSpec
from strideframe.operators import export as E
from strideframe.operators.ordering import indexed_rows
from strideframe.operators.windows import AnchorGrid, anchor_statistics, hot_frames
from strideframe.plans.build import MANIFEST
from strideframe.plans.export_files import write_export
from strideframe.sources import files, scratch


@pytest.fixture(scope="module")
def many_chunks(tmp_path_factory, sf_dir):
    """The test tables with conversation numbers beyond 10,000, so that the numbers of their chunks of 10 have four digits."""
    place = tmp_path_factory.mktemp("many-chunks")
    for name in oracle.TABLES:
        if name != "conversations":
            os.symlink(f"{sf_dir}/{name}.parquet", place / f"{name}.parquet")
    shifted = f"select * replace (conv_id + 10005 as conv_id) from '{sf_dir}/conversations.parquet'"
    duckdb.sql(f"copy ({shifted}) to '{place}/conversations.parquet' (format parquet)")
    return str(place)


def test_contract_all_with_four_digit_chunks(spark, many_chunks):
    duck = oracle.connect(many_chunks)
    assert duck.execute("select max(conv_id) from conversations").fetchone()[0] >= 10000
    assert oracle.compare(duck, ORACLES["contract_all"], QUERIES["contract_all"](spark, many_chunks)) is None


@pytest.fixture(scope="module")
def in_parts(spark, tmp_path_factory, sf_dir):
    """The test tables with two of them as folders of part files, and one without rows."""
    place = tmp_path_factory.mktemp("in-parts")
    folders = ("documents", "conversations")
    for name in oracle.TABLES:
        if name in folders:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{place}/{name}.parquet")
        elif name == "labels":
            duckdb.sql(f"copy (from '{sf_dir}/labels.parquet' limit 0) to '{place}/labels.parquet' (format parquet)")
        else:
            os.symlink(f"{sf_dir}/{name}.parquet", place / f"{name}.parquet")
    duck = duckdb.connect()
    for name in oracle.TABLES:
        files = f"{place}/{name}.parquet" + ("/*.parquet" if name in folders else "")
        duck.execute(f"create view {name} as select * from read_parquet('{files}')")
    return str(place), duck


@pytest.mark.parametrize("name", ["file_inventory", "file_row_counts"])
def test_files_of_tables_in_parts(spark, in_parts, name):
    place, duck = in_parts
    assert oracle.compare(duck, ORACLES[name], QUERIES[name](spark, place)) is None


# --- many small folders -----------------------------------------------------------------------------------------------


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    folders, most = 64, 4 * spark.sparkContext.defaultParallelism
    assert most < folders
    spark.range(folders).selectExpr("id", "id as folder").repartition(1).write.partitionBy("folder").parquet(f"{tmp_path}/t")
    before = spark.conf.get(files.LISTING_TASKS)
    spark.sparkContext.setJobGroup("listing", "read a tree of folders")
    try:
        rows = files.read_parquet_tree(spark, f"{tmp_path}/t")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert 1 < max(stage.numTasks for stage in stages) <= most
    assert spark.conf.get(files.LISTING_TASKS) == before
    assert sorted(r["id"] for r in rows.collect()) == list(range(folders))


def test_side_tables_of_an_export_do_not_read_its_data_folders(spark, built, tmp_path, monkeypatch):
    base, _, store = built
    read = {}
    for name in ("export_chunks", "export_episodes", "export_info"):
        def watched(rows, *args, plain=getattr(E, name), name=name):
            read[name] = rows.inputFiles()
            return plain(rows, *args)

        monkeypatch.setattr(E, name, watched)
    manifest = indexed_rows(store.read(MANIFEST), "index")
    frames = files.read_parquet_tree(spark, f"{base}/snapshot/data")
    refs = spark.createDataFrame([], "episode_id string, position int, video_key string, path string, exists boolean")
    done = write_export(manifest, frames, refs, str(tmp_path / "e"), "2026-01-01T00:00:00+00:00", chunk_rows=10)
    assert len(read) == 3 and not [f for paths in read.values() for f in paths if "chunk_index=" in f]
    data = spark.read.parquet(f"{done['export_dir']}/data")
    for row in data.groupBy("chunk_index").agg(F.min("index"), F.max("index") + 1, F.count("*")).collect():
        assert spark.read.parquet(f"{done['export_dir']}/meta/chunks").where(F.col("chunk_index") == row[0]).first()[1:] == row[1:]


# --- bytes shuffled by the window join ---------------------------------------------------------------------------------


def test_frames_enter_their_cells_narrow(spark, capsys):
    frames = spark.createDataFrame([(1, 0, 0.5), (1, 1, 1.5)], "episode long, frame long, ts double")
    anchor_statistics(frames, AnchorGrid(30, WindowSpec(-10, 0, 1, 10))).explain("formatted")
    shuffles = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(episode#\d+L, cell#\d+L,", capsys.readouterr().out)
    assert len(shuffles) == 1
    assert sorted(re.findall(r"(\w+)#", shuffles[0])) == ["cell", "copies", "episode", "frame", "ts"]


def test_frame_numbers_are_counted_only_where_one_can_be_hot(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(scratch, "store", lambda df, label, store=scratch.store: stored.append(label) or store(df, label))
    spread = spark.range(3000).selectExpr("id % 7 as episode", "id as frame", "double(id) as ts")
    assert hot_frames(spread, 1000) is None and stored == ["full-buckets"]
    hot = spread.union(spark.range(1500).selectExpr("3L as episode", "5L as frame", "double(id) as ts"))
    found = hot_frames(hot, 1000).collect()
    assert [(r["episode"], r["frame"], r["copies"]) for r in found] == [(3, 5, 1500)]


def test_lines_are_numbered_in_few_pieces(spark, sf_dir, capsys):
    """A supplier has about one line a day: a piece for every day would be a row for every line."""
    X.line_frames(spark, sf_dir).explain("formatted")
    keys = re.findall(r"hashpartitioning\((l_suppkey#\d+L, [^)]*), \d+\)", capsys.readouterr().out)
    assert keys and not [k for k in keys if "l_shipdate" in k]
