"""Order-independent content digest.

Each row is hashed on its own and the hashes are added up, so the digest is one ordinary aggregate: it combines
map-side, ends in a single row and does not depend on partitioning or row order. Repeated rows count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.columns import col

_WORDS = 4  # a sha256 has four 16-digit hexadecimal words


def row_digest(names: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[col(name) for name in names])), 256)


def content_digest(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row: ``rows``, ``content_sha256`` and ``content_version`` (its first 16 digits)."""
    hashed = df.select(row_digest(list(names or df.columns)).alias("h"))
    sums = [
        F.coalesce(
            F.sum(F.conv(F.substring("h", 1 + 16 * word, 16), 16, 10).cast("decimal(28,0)")),
            F.lit(0).cast("decimal(38,0)"),
        ).alias(f"w{word}")
        for word in range(_WORDS)
    ]
    total = hashed.agg(F.count(F.lit(1)).alias("rows"), *sums)
    parts = [F.col("rows").cast("string")] + [F.col(f"w{word}").cast("string") for word in range(_WORDS)]
    return total.select("rows", F.sha2(F.concat_ws(":", *parts), 256).alias("content_sha256")).withColumn(
        "content_version", F.substring("content_sha256", 1, 16)
    )
