"""Small tables made of values the driver holds: settings, log entries, documents."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str | T.StructType) -> DataFrame:
    """Rows as literals of the plan: no task ships them, and their size is known when joins are planned."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields

    def values(row: Sequence[Any]) -> list:
        return [F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, fields)]

    if not rows:
        return spark.range(0).select(*values([None] * len(fields)))
    return one_row(spark).select(F.inline(F.array(*[F.struct(*values(row)) for row in rows])))


def one_row(spark: SparkSession) -> DataFrame:
    """A row to hang literals on, in a single partition."""
    return spark.range(0, 1, 1, 1)
