"""Column names: normalising, guarding and picking."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_name(name: str) -> str:
    words = re.findall(r"[0-9A-Za-z]+", name)
    if not words:
        return "col"
    joined = "_".join(words).lower()
    return f"col_{joined}" if joined[0].isdigit() else joined


def safe_names(names: Iterable[str]) -> list[str]:
    """Normalised names in column order; later duplicates get ``_2``, ``_3``, ..."""
    taken: dict[str, None] = {}
    for name in names:
        base = safe_name(name)
        options = (base if n == 1 else f"{base}_{n}" for n in range(1, len(taken) + 2))
        taken[next(option for option in options if option not in taken)] = None
    return list(taken)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"required columns not found: {absent}")


def first_present(names: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((name for name in candidates if name in names), None)


def any_null(names: Sequence[str]) -> Column:
    """True when at least one of the columns is NULL; false for an empty list."""
    test = F.lit(False)
    for name in names:
        test = test | col(name).isNull()
    return test
