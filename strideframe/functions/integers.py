"""Exact integer arithmetic on long columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div_sql(value: str, divisor: int) -> str:
    """Floor division for a positive divisor, also for negative values, as SQL text."""
    return f"((({value}) - pmod(({value}), {divisor})) div {divisor})"


def floor_div(column: str, divisor: int) -> Column:
    return F.expr(floor_div_sql(column, divisor))
