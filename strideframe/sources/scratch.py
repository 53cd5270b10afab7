"""Where intermediate tables go.

On a cluster this must be a folder all executors share, named by ``spark.checkpoint.dir``. Only a session whose driver
is its one executor (master ``local`` or ``local[n]``) falls back to a folder on this machine when that is unset.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_base: list[str] = []
_places: list[str] = []


def _base(spark: SparkSession) -> str:
    if _places:
        return _places[-1]
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_base:
        _local_base.append(tempfile.mkdtemp(prefix="strideframe-"))
        atexit.register(shutil.rmtree, _local_base[0], ignore_errors=True)
    return _local_base[0]


@contextmanager
def removed_after(spark: SparkSession, label: str) -> Iterator[str]:
    """Everything stored inside the block goes below one folder, removed at its end."""
    place = new_path(spark, label)
    _places.append(place)
    try:
        yield place
    finally:
        _places.remove(place)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_base(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
