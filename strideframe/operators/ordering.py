"""Positions in a total order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.columns import col
from strideframe.sources import scratch


def indexed_rows(stored: DataFrame, name: str = "index") -> DataFrame:
    """0-based position of every row of a Parquet table, in file order and row order within a file.

    ``stored`` must be a plain read of Parquet files. A table written from ``orderBy`` keeps its sort order over
    its file names, so this numbers the sorted rows, also when it was written into numbered folders in that order. The
    window below runs over one row per file.
    """
    meta = F.col("_metadata")
    located = stored.select(
        *[col(c) for c in stored.columns], meta["file_path"].alias("_file"), meta["row_index"].alias("_row")
    )
    sizes = stored.select(meta["file_path"].alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    # part-<n>-<uuid>-c<m>: numbers, because the zero padding ends at five digits; any other name has no known place
    number = F.regexp_extract("_file", r"/part-(\d+)-[^/]*$", 1).try_cast("long")
    unknown = F.raise_error(F.concat(F.lit("not a part file of a Spark write, so its place is unknown: "), "_file"))
    part = F.coalesce(number, unknown.cast("long"))
    split = F.regexp_extract("_file", r"-c(\d+)\.[^/]*$", 1).try_cast("long")
    folder = F.regexp_extract("_file", r"=(\d+)/[^/]*$", 1).try_cast("long")
    before = Window.orderBy(part, folder, split, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return located.join(offsets, "_file").select(
        *[col(c) for c in stored.columns], (F.col("_offset") + F.col("_row")).alias(name)
    )


def sort_stored(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``order``, from a stored copy.

    A range sort reads its input twice, once to sample it; the copy saves running the plan of ``df`` twice. The
    place of a row in the copy is the last sort key: it never changes, and it lets the sort split rows that are
    equal in ``order`` over several tasks.
    """
    return sort_placed(scratch.store(df, "unsorted"), order)


def sort_placed(stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """The same for a table that is stored already: a plain read of Parquet files, sorted without another copy."""
    meta = F.col("_metadata")
    placed = stored.select(
        *[col(c) for c in stored.columns], meta["file_name"].alias("_file"), meta["row_index"].alias("_row")
    )
    return placed.orderBy(*[col(c) for c in order], "_file", "_row").drop("_file", "_row")


def with_global_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """``df`` with its 0-based position by ``order``: one range sort into a stored table, then file offsets."""
    return indexed_rows(scratch.store(sort_stored(df, order), "ordered"), name)


def with_group_position(
    df: DataFrame, group: Sequence[str], cell: str, order: Sequence[str], name: str = "position"
) -> DataFrame:
    """0-based position within a group, for groups of any size.

    ``cell`` cuts each group into ordered pieces (all rows of a lower cell come first). Rows are numbered inside a
    piece and shifted by the rows of the pieces before it, so a task never holds more than one piece.
    """
    keys = [*group, cell]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    return (
        df.withColumn("_inside", inside)
        .join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_inside") - 1)
        .drop("_offset", "_inside")
    )
