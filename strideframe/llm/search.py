"""Exact top-k search by integer inner product.

Every vector becomes whole numbers, floor(64 x). Queries and candidates are packed into blocks; a task multiplies one
block of queries with one shard of candidates, keeps each query's best ``k`` of that tile, and lists are merged in groups
of ``FAN_IN`` until one is left. A query block meets every shard once (a stated query set against all rows, in blocks).
Scores are computed in double precision where they are exact (below 2^53), else as Python integers; a score beyond a
long is reported as the nearest long, after ranking by its exact value.

Nulls and repeats: rows with a null id, a null vector, or a null, NaN or infinite component take no part. Only vectors
of equal length are compared. Repeated rows are rows of their own, as queries and as candidates; a query never meets rows
of its own id; each row under a query id gives its own list. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.sources import scratch

SCALE = 64
QUERY_BLOCK = 1024
SHARD = 8192
FAN_IN = 16
_LONG = (1 << 63) - 1


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, x`` (array of double) of the rows that take part."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    rows = vectors.select(F.col(id).alias("id"), x.alias("x")).where("id is not null and x is not null")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(~F.coalesce(bad, F.lit(True)))


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Stored rows packed by vector length and block: ``dim, <name>, ids, data, scaled``.

    Blocks are dealt by a row's place in the stored table, so that repeated rows spread as well. ``data`` holds whole
    numbers floor(64 x), or x itself (``scaled`` false) where 64 x would pass the largest double.
    """
    counts = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"))
    placed = rows.select("id", "x", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place"))
    dealt = placed.withColumn("dim", F.size("x")).join(counts, "dim").withColumn(
        name, F.pmod(F.col("place"), F.ceil(F.col("n") / size)).cast("int")
    )

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        data = table.column("x").combine_chunks().flatten().to_numpy()
        scaled = bool(np.abs(data).max(initial=0) < 2.0**1000)
        if scaled:
            data = np.floor(data * SCALE)
        ids = table.column("id").to_numpy()
        return pa.table(
            {
                "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
                name: pa.array([table.column(name)[0].as_py()], pa.int32()),
                "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                "data": pa.array([data.astype(np.float64).tobytes()], pa.binary()),
                "scaled": pa.array([scaled]),
            }
        )

    return dealt.select("dim", name, F.col("id").cast("long").alias("id"), "x").groupBy("dim", name).applyInArrow(
        pack, f"dim int, {name} int, ids binary, data binary, scaled boolean"
    )


def _unscaled(data: np.ndarray) -> np.ndarray:
    """floor(64 x) as Python integers."""
    return np.array([int(v) * SCALE if abs(v) >= 2.0**60 else int(np.floor(v * SCALE)) for v in data.ravel()], object).reshape(data.shape)


def tile_scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles when no sum can pass 2^53, else as Python integers."""
    if queries.dtype == object or shard.dtype == object:
        most = 2**53
    else:
        most = (np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return queries @ shard.T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
    return whole(queries) @ whole(shard).T


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of a list, by falling score, then rising id."""
    if scores.dtype != object and len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    if scores.dtype == object:
        return np.array(sorted(some.tolist(), key=lambda p: (-scores[p], ids[p]))[:k], np.int64)
    return some[np.lexsort((ids[some], -scores[some]))][:k]


_LISTS = "dim int, block int, part int, lists binary"


def _save(lists: list[tuple[np.ndarray, list]]) -> bytes:
    """Per query: found ids and exact scores, as an Arrow stream (scores as text, exact at any size)."""
    table = pa.table(
        {
            "ids": pa.array([i.tolist() for i, _ in lists], pa.list_(pa.int64())),
            "scores": pa.array([[str(int(s)) for s in v] for _, v in lists], pa.list_(pa.string()))
            if any(abs(int(s)) > _LONG for _, v in lists for s in v)
            else pa.array([[int(s) for s in v] for _, v in lists], pa.list_(pa.int64())),
        }
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _load(raw: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    table = pa.ipc.open_stream(raw).read_all()
    text = pa.types.is_string(table.schema.field("scores").type.value_type)
    return [
        (np.array(i, np.int64), np.array([int(s) for s in v], object if text else np.int64))
        for i, v in zip(table.column("ids").to_pylist(), table.column("scores").to_pylist())
    ]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score`` of each query's ``k`` best rows; ``is_query`` is a condition on the id column."""
    rows = scratch.store(usable(vectors, id, vector), "vectors")
    marked = rows.withColumnRenamed("id", id).where(is_query).withColumnRenamed(id, "id")
    queries = scratch.store(_blocks(marked, QUERY_BLOCK, "block"), "query-blocks")
    shards = scratch.store(_blocks(rows, SHARD, "shard"), "shards")
    counts = shards.groupBy("dim").agg(F.max("shard").alias("last"))
    tiles = (
        queries.join(counts, "dim")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select("dim", "block", "shard", F.col("ids").alias("query_ids"), F.col("data").alias("query_data"), F.col("scaled").alias("query_scaled"))
        .join(shards, ["dim", "shard"])
        .select("dim", "block", F.col("shard").alias("part"), "query_ids", "query_data", "query_scaled", "ids", "data", "scaled")
    )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in (batch.slice(n, 1) for n in range(batch.num_rows)):
                dim = tile.column("dim")[0].as_py()
                own, other = (np.frombuffer(tile.column(c)[0].as_py(), np.int64) for c in ("query_ids", "ids"))
                left, right = (
                    np.frombuffer(tile.column(c)[0].as_py(), np.float64).reshape(n, dim)
                    for c, n in (("query_data", len(own)), ("data", len(other)))
                )
                left = left if tile.column("query_scaled")[0].as_py() else _unscaled(left)
                right = right if tile.column("scaled")[0].as_py() else _unscaled(right)
                lists = []
                for a in range(0, len(own), 128):
                    for one, scores in zip(own[a : a + 128], tile_scores(left[a : a + 128], right)):
                        open_ = np.flatnonzero(other != one)
                        scores = scores[open_]
                        at = best_of(scores, other[open_], k)
                        lists.append((other[open_][at], scores[at].tolist()))
                yield pa.RecordBatch.from_pydict(
                    {c: tile.column(c) for c in ("dim", "block", "part")} | {"lists": pa.array([_save(lists)], pa.binary())}
                )

    def merge(table: pa.Table) -> pa.Table:
        loaded = [_load(raw) for raw in table.column("lists").to_pylist()]
        merged = []
        for several in zip(*loaded):
            ids = np.concatenate([i for i, _ in several])
            scores = np.concatenate([s for _, s in several])
            at = best_of(scores, ids, k)
            merged.append((ids[at], scores[at].tolist()))
        return pa.table(
            {
                "dim": table.column("dim")[:1],
                "block": table.column("block")[:1],
                "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                "lists": pa.array([_save(merged)], pa.binary()),
            }
        )

    lists = tiles.mapInArrow(multiply, _LISTS)
    last = counts.agg(F.max("last")).first()[0] or 0
    while True:
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        lists = lists.groupBy("dim", "block", "part").applyInArrow(merge, _LISTS)
        last //= FAN_IN
        if last == 0:
            break

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, ids in zip(batch.column("lists").to_pylist(), batch.column("ids").to_pylist()):
                query, rank, found, score = [], [], [], []
                for one, (got, scores) in zip(np.frombuffer(ids, np.int64).tolist(), _load(raw)):
                    query += [one] * len(got)
                    rank += range(1, len(got) + 1)
                    found += got.tolist()
                    score += [max(-_LONG - 1, min(_LONG, int(s))) for s in scores]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(rank, pa.int32()), pa.array(found, pa.int64()), pa.array(score, pa.int64())],
                    names=["query_id", "rank", id, "score"],
                )

    final = lists.select("dim", "block", "lists").join(queries.select("dim", "block", "ids"), ["dim", "block"])
    return final.select("ids", "lists").mapInArrow(spread, f"query_id long, rank int, `{id}` long, score long")
