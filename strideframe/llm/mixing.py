"""Mix sources to target weights.

A source's rate is its target size over its own size. Every document is taken floor(rate) times, and once more when a
number drawn from a hash of seed and id lies below the fraction, so a rerun takes the same documents.

Targets: sources in code-point order (null last) get the weights in turn and share ``share`` of the total size; a target
stops at ``most`` times its source's size and the excess is shared again by weight among the rest. With a level L the
target is min(most * size, L * weight), and L is found by repeating one aggregate over the source table.

Nulls and repeats: null text has size 0; a null source is a source of its own; a null id draws like the text "null";
rows with equal ids draw the same number. A source without words has target 0. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.sources import scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
#: A source table of at most so many rows is broadcast; beyond it the join is by shuffle.
BROADCAST_SOURCES = 10_000
#: columns the mix adds; those of the input with such names are replaced
RESERVED = ("mix_size", "mix_source", "mix_source_size", "mix_target", "mix_copies", "mix_turn")


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``source, source_size, target`` from ``sizes(source, size)`` with one row per document."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    table = scratch.store(totals.withColumn("weight", weight), "sources")  # one row per source
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, seen = 0.0, -1
    while True:  # sources only ever reach their limit, so this ends after one turn for each that does
        full = F.col("source_size") * most <= F.col("weight") * level
        capped, count, rest = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(full, 1)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if count == seen or not rest:
            break
        seen, level = count, (share * total - capped) / rest
    return table.select(
        "source",
        "source_size",
        F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(float(level))).alias("target"),
    )


def draw(id: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from 32 bits of a hash of seed and id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies``."""
    sized = docs.drop(*RESERVED).withColumn("mix_size", word_count(text))
    targets = source_targets(sized.select(F.col(source).alias("source"), F.col("mix_size").alias("size")), weights, share, most)
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    targets = targets.select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")
    )
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    return (
        sized.join(F.broadcast(targets) if few else targets, sized[source].eqNullSafe(F.col("mix_source")))
        .withColumn("mix_copies", (F.floor(rate) + (draw(id, seed) < rate - F.floor(rate)).cast("int")).cast("int"))
        .drop("mix_source")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as many times as the mix takes it, with the columns it had before the mix."""
    return (
        mixed.where("mix_copies > 0")
        .withColumn("mix_turn", F.explode(F.sequence(F.lit(1), "mix_copies")))
        .drop(*RESERVED)
    )
