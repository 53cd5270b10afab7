"""Rows of a stored table by their place in it: choose on narrow columns first, read wide columns only for what was chosen.

A place is the file a row lies in (a 64-bit hash of its path) and its number in that file. Chosen places become one bit
each, 64 rows a word, and the table is read once with those words broadcast, so rows that were not chosen never enter an
exchange. Their number is checked first: beyond ``MOST_PLACES`` the files are dealt into batches by hash of the path. Each
batch reads its own files only and broadcasts its own words, so the table is still read once and no broadcast grows
with it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions.columns import col
from strideframe.sources import scratch

FILE, ROW = "_file", "_row"
#: places broadcast at once: 200 MB where no two of them share a word
MOST_PLACES = 4_000_000


def placed(table: DataFrame) -> DataFrame:
    """``table`` with the place of every row (``_file, _row``). One that is not read from Parquet files is stored first."""
    try:
        return _with_place(table)
    except AnalysisException:
        return _with_place(scratch.store(table, "placed"))


def _with_place(table: DataFrame) -> DataFrame:
    place = [F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)]
    return table.select(*[col(c) for c in table.columns], *place)


def words_of(places: DataFrame) -> DataFrame:
    """``_file, _word, _bits``: one bit for each of the places ``(_file, _row)``."""
    bit = F.expr(f"shiftleft(1L, cast({ROW} % 64 as int))")
    return places.groupBy(FILE, F.expr(f"{ROW} div 64").alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _at(table: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of a placed table whose bit is set; the words are of a size that was checked."""
    words = F.broadcast(words.withColumnRenamed(FILE, "_word_file"))
    on = (F.col(FILE) == F.col("_word_file")) & (F.expr(f"{ROW} div 64") == F.col("_word"))
    found = table.join(words, on).where(F.expr(f"getbit(_bits, cast({ROW} % 64 as int)) = 1"))
    return found.select(*[col(c) for c in table.columns])


def rows_at(table: DataFrame, places: DataFrame, most: int | None = None) -> DataFrame:
    """The rows of a placed table at the stored ``places`` (``_file, _row``, repeats allowed)."""
    batches = -(-places.count() // (most or MOST_PLACES))
    if batches <= 1:
        return _at(table, words_of(places))
    path = scratch.new_path(table.sparkSession, "rows-at")
    for batch in range(batches):
        mine = F.pmod(F.col(FILE), F.lit(batches)) == batch
        _at(table.where(mine), words_of(places.where(mine))).write.mode("append").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
