"""Whitening of embeddings onto their leading principal components.

Every vector becomes whole numbers, x = floor(64 c) + 1,000,000. The components are fitted on each distinct x vector once:
copies collapse in every task before the only shuffle, which moves vectors packed to one, two, four or eight bytes an entry. Two passes over
that list add up, in exact integers, the sums S and then the products of entries centred at the whole number nearest their
mean; the covariance follows from them without rounding. Its leading eigenpairs come from ``spectrum`` (inertia counts and
Rayleigh quotient iteration) on the driver, which holds one d x d matrix for vectors of d entries, whatever their number. A third pass
measures the covariance of the whitened list.

Nulls and repeats: a row whose vector is null, or holds a null or non-finite entry or one of ``LARGEST`` or more after
scaling, takes no part; a null id is an id like any other; repeated rows each give their rows and count once in the fit.
Vectors of different lengths are fitted and whitened apart, one length after the other; empty vectors have no components.
Components without variance have ``whitened`` null and do not count in ``identity_error``, which is one value for all rows, the largest
over the lengths. ``explained`` is null where nothing varies. A deviation beyond a long is null. Only the two named
columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm.spectrum import leading_pairs
from strideframe.sources import scratch

SCALE = 64
COMPONENTS = 16
#: whole numbers from here on are not exact enough for the sums below
LARGEST = 1 << 45
_ROWS = 8192
_LONG = (1 << 63) - 1


@dataclass
class Fit:
    """The fit of one vector length. ``sums`` are those of floor(64 c); the constant of x cancels everywhere."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def centre(self) -> np.ndarray:
        """The whole number nearest each mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def varying(self) -> np.ndarray:
        return self.values > len(self.sums) * np.finfo(np.float64).eps * max(self.trace, 0.0)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows centred at the mean, projected, over the root of the eigenvalue (nan without variance)."""
        rest = np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre)], np.float64) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            roots = np.where(self.varying, np.sqrt(np.maximum(self.values, 0)), np.nan)
            return ((x - self.centre).astype(np.float64) - rest) @ self.vectors / roots

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if most < 1 << 62 and most * most * max(1, x.shape[1]) <= _LONG:
            off = x * self.n - np.array(self.sums, np.int64)
            return pa.array((off * off).sum(1), pa.int64())
        off = x.astype(object) * self.n - np.array(self.sums, object)
        return pa.array([v if v <= _LONG else None for v in (off * off).sum(1).tolist()], pa.int64())


def _whole(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each vector length of a batch: the length, the rows that take part and their whole numbers."""
    vectors = batch.column(column)
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()  # leaves null rows out
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        block = values[ends[rows][:, None] + np.arange(dim)]
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(block * SCALE)
            usable = (np.abs(scaled) < LARGEST).all(1)  # false for nan and infinity
        yield dim, rows[usable], scaled[usable].astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, _, x in _whole(batch):
            most = np.maximum(x.max(1, initial=0), -1 - x.min(1, initial=0))
            width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
            packed = [b""] * len(x)
            for size in np.unique(width).tolist():
                at = np.flatnonzero(width == size)
                for row, value in zip(at.tolist(), x[at].astype(f"<i{size}")):
                    packed[row] = value.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(x), pa.int32()), pa.array(packed, pa.binary())], names=["dim", "x"])


def _unpacked(batch: pa.RecordBatch, dim: int) -> Iterator[np.ndarray]:
    """The rows of a batch as whole numbers, for each packed width."""
    raw = batch.column("x")
    sizes = pc.binary_length(raw).to_numpy() // dim
    for size in np.unique(sizes).tolist():
        some = raw.filter(pa.array(sizes == size))
        joined = b"".join(v.as_py() for v in some)
        yield np.frombuffer(joined, f"<i{size}").reshape(-1, dim).astype(np.int64)


def distinct_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """``dim, x`` (packed) of each distinct vector."""
    packed = vectors.select(F.col(vector).alias("v")).where("v is not null").mapInArrow(_pack, "dim int, x binary")
    return packed.distinct()


_WHOLE = "decimal(38,0)"


def _added(partials: DataFrame, column: str, kind: str) -> DataFrame:
    """Arrays of several tasks, added up entry by entry: ``i, j, total``."""
    return partials.select("i", F.posexplode(column).alias("j", "value")).groupBy("i", "j").agg(F.sum("value").cast(kind).alias("total"))


def _sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each entry."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            for x in _unpacked(batch, dim):
                n += len(x)
                for at in range(0, len(x), _ROWS):
                    total = total + x[at : at + _ROWS].sum(0).astype(object)
        if n:
            entries = [Decimal(int(v)) for v in [n, *total]]
            yield pa.RecordBatch.from_pydict({"i": pa.array([0], pa.int32()), "a": pa.array([entries], pa.list_(pa.decimal128(38, 0)))})

    found = _added(rows.mapInArrow(work, f"i int, a array<{_WHOLE}>"), "a", _WHOLE).collect()
    by_place = {r["j"]: int(r["total"]) for r in found}
    return by_place[0], [by_place[k + 1] for k in range(dim)]


def _products(rows: DataFrame, dim: int, centre: np.ndarray) -> np.ndarray:
    """The exact sums of products of centred entries, as Python integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        seen = False
        for batch in batches:
            for x in _unpacked(batch, dim):
                seen = True
                x = x - centre
                most = int(np.abs(x).max(initial=0)) ** 2
                if most < 1 << 40:  # doubles hold these sums exactly
                    step = min(_ROWS, (1 << 53) // max(1, most))
                    for at in range(0, len(x), step):
                        part = x[at : at + step].astype(np.float64)
                        total = total + (part.T @ part).astype(np.int64).astype(object)
                else:
                    for at in range(0, len(x), _ROWS):
                        part = x[at : at + _ROWS].astype(object)
                        total = total + part.T @ part
        if seen:
            for i in range(dim):
                entries = [Decimal(int(v)) for v in total[i, : i + 1]]
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "a": pa.array([entries], pa.list_(pa.decimal128(38, 0)))})

    out = np.zeros((dim, dim), object)
    for r in _added(rows.mapInArrow(work, f"i int, a array<{_WHOLE}>"), "a", _WHOLE).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["total"])
    return out


def _identity_error(rows: DataFrame, dim: int, fit: Fit) -> float:
    """The largest entry of the covariance of the whitened list minus the identity."""
    open_ = np.flatnonzero(fit.varying)
    if not len(open_):
        return 0.0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(open_), len(open_)))
        sums = np.zeros(len(open_))
        for batch in batches:
            for x in _unpacked(batch, dim):
                for at in range(0, len(x), _ROWS):
                    w = fit.whiten(x[at : at + _ROWS])[:, open_]
                    total += w.T @ w
                    sums += w.sum(0)
        flat = np.concatenate([total.ravel(), sums]).tolist()
        yield pa.RecordBatch.from_pydict({"i": pa.array([0], pa.int32()), "a": pa.array([flat], pa.list_(pa.float64()))})

    added = {r["j"]: r["total"] for r in _added(rows.mapInArrow(work, "i int, a array<double>"), "a", "double").collect()}
    m = len(open_)
    flat = np.array([added[k] for k in range(m * m + m)]) / fit.n
    mean = flat[m * m :]
    return float(np.abs(flat[: m * m].reshape(m, m) - np.outer(mean, mean) - np.eye(m)).max())


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each vector length in the table."""
    distinct = scratch.store(distinct_vectors(vectors, vector), "whitening")
    fits: dict[int, Fit] = {}
    for dim in sorted(r["dim"] for r in distinct.select("dim").distinct().collect()):
        rows = distinct.where(F.col("dim") == dim).select("x")
        n, sums = _sums(rows, dim)
        own = Fit(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
        products = _products(rows, dim, own.centre)
        rest = [s - n * int(c) for s, c in zip(sums, own.centre)]
        # whole numbers up to the last division, which rounds once
        covariance = np.array([[(n * products[i, j] - rest[i] * rest[j]) / (n * n) for j in range(dim)] for i in range(dim)])
        own.trace = sum(n * products[i, i] - rest[i] ** 2 for i in range(dim)) / (n * n)
        own.values, own.vectors = leading_pairs(covariance, components)
        own.identity_error = _identity_error(rows, dim, own)
        fits[dim] = own
    return fits


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: ``id, component, n, deviation, whitened, explained, identity_error``."""
    fits = fit(vectors, vector, components)
    error = max((f.identity_error for f in fits.values()), default=0.0)
    source = vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")).where("v is not null")
    schema = T.StructType(
        [T.StructField(id, source.schema["id"].dataType), T.StructField("component", T.IntegerType()),
         T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
         T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, _ROWS) for at in range(0, whole.num_rows, _ROWS)):
                for dim, rows, x in _whole(batch):
                    own, m = fits[dim], min(components, dim)
                    at = np.repeat(np.arange(len(rows)), m)
                    white = own.whiten(x).ravel()
                    explained = own.values / own.trace if own.trace > 0 else np.full(m, np.nan)
                    shares = np.tile(explained, len(rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(rows[at])), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(rows))),
                         pa.array(np.full(len(at), own.n)), own.deviations(x).take(pa.array(at)),
                         pa.array(white, mask=np.isnan(white)), pa.array(shares, mask=np.isnan(shares)),
                         pa.array(np.full(len(at), error))],
                        names=[id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return source.mapInArrow(work, schema)
