"""Near-duplicate groups: banded MinHash candidates, sequential Bayesian pruning, exact confirmation.

A document's set holds its distinct shingles of ``SHINGLE`` words (ASCII case folded; a shorter text is one shingle,
a text without words has an empty set and no links). Documents are linked when their sets' Jaccard similarity is at
least ``percent`` / 100, checked on the words themselves.

1. Rows with equal sets become one class at once (a digest of the whole set), so exact copies cost one row each.
2. ``bands_for(percent)`` x ``ROWS`` MinHash values; classes that share a band are candidates. There are as many bands as
   a pair at the threshold needs to be missed with probability 1e-6 at most, ``BANDS`` at least: 24 at 0.85 (about
   7e-7), 35 at 0.8.
3. A candidate pair is compared ``BATCH`` values at a time, the first ``BANDS`` x ``ROWS`` at most. With a uniform prior the similarity after m of n equal
   values is Beta(m + 1, n - m + 1); the pair is dropped when the posterior probability of reaching the threshold
   falls below ``miss``.
4. Survivors are confirmed on their full sets.

Pairs are not written out for whole groups. In a pivot round each class meets one member of its buckets that is not yet
in its component; one confirmed link is enough. After ``PIVOT_ROUNDS`` rounds every bucket that still holds several
components is cut into blocks of bounded size, and a task compares two blocks in place: every pair of different
components is checked and only confirmed links leave the task. No link between different components is lost and
buckets need no cap.

Nulls and repeats: a row without id is returned with a null component and ``kept`` true; null text is an empty set.
Rows that share an id count as one document with the links of all its texts.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import hashing as H
from strideframe.llm.arrow import slices, text_buffers
from strideframe.llm.components import components
from strideframe.sources import scratch

SHINGLE = 5
BANDS, ROWS = 24, 5
BAND_MISS = 1e-6
BATCH = 24
PIVOT_ROUNDS = 2
BLOCK_ROWS, BLOCK_SHINGLES = 768, 300_000
#: lists of at most so many ids (of 8 bytes) are broadcast; longer ones are joined by shuffle
BROADCAST_IDS = 1_000_000
_SEED = 11


def bands_for(percent: int) -> int:
    """Bands that miss a pair at the threshold with probability ``BAND_MISS`` at most; never fewer than ``BANDS``."""
    shared = (percent / 100) ** ROWS
    return BANDS if shared >= 1 else max(BANDS, math.ceil(math.log(BAND_MISS) / math.log1p(-shared)))


@functools.lru_cache(maxsize=4)
def _permutations(bands: int) -> tuple[np.ndarray, np.ndarray]:
    values = H.stream(_SEED + 1, 2 * bands * ROWS).astype(np.uint32)
    return values[::2, None] | np.uint32(1), values[1::2, None]


def signature(shingles: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """MinHash values of a set of 64-bit shingle hashes."""
    factor, shift = _permutations(bands)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(bands * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, (factor * short[at : at + 2048] + shift).min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band for each signature row; the band's number is part of the key."""
    parts = values.reshape(-1, values.shape[1] // ROWS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        keys = H.mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys.view(np.int64)


def features(docs: DataFrame, id: str = "doc_id", text: str = "text", n_bands: int = BANDS) -> DataFrame:
    """``id, n_shingles, digest, signature, bands`` for every row."""
    fields = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", fields.schema["id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("signature", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            data, ends = text_buffers(batch.column("text"))
            starts, stops, offsets = H.word_spans(data, ends)
            words = H.word_hashes(data, starts, stops, _SEED, fold_case=True)
            all_windows = H.windows(words, SHINGLE, _SEED)
            sizes = np.zeros(batch.num_rows, np.int64)
            digests: list[bytes | None] = [None] * batch.num_rows
            values = np.zeros((batch.num_rows, n_bands * ROWS), np.uint32)
            for row, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
                if lo == hi:
                    continue
                if hi - lo < SHINGLE:
                    own = H.windows(words[lo:hi], int(hi - lo), _SEED)
                else:
                    own = np.unique(all_windows[lo : hi - SHINGLE + 1])
                sizes[row] = len(own)
                digests[row] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                values[row] = signature(own, n_bands)
            full = sizes > 0
            keys, width = band_keys(values), values.shape[1] * 4
            raw = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes),
                    pa.array(digests, pa.binary()),
                    pa.array([raw[i * width : (i + 1) * width] if f else None for i, f in enumerate(full)], pa.binary()),
                    pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "digest", "signature", "bands"],
            )

    return fields.mapInArrow(work, schema)


def least_matches(percent: int, miss: float) -> list[tuple[int, int]]:
    """``(n, m)``: after n compared values a pair with fewer than m equal ones is dropped.

    P(Beta(m + 1, n - m + 1) >= t) equals P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        term = total = (1 - t) ** (n + 1)
        m = 0
        while total < miss:
            term *= (n + 1 - m) / (m + 1) * t / (1 - t)
            total += term
            m += 1
        out.append((n, m))
    return out


def bayes_filter(pairs: DataFrame, percent: int, miss: float) -> DataFrame:
    """Rows of ``pairs(a, b, left, right)`` whose signatures leave the threshold possible."""
    steps = least_matches(percent, miss)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(text_buffers(batch.column(side))[0].tobytes(), np.uint32).reshape(batch.num_rows, -1)
                for side in ("left", "right")
            )
            alive, equal, at = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, least in steps:
                equal[alive] += (left[alive, at:n] == right[alive, at:n]).sum(axis=1)
                alive, at = alive[equal[alive] >= least], n
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return pairs.mapInArrow(work, pairs.select("a", "b").schema)


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < SHINGLE:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(SHINGLE))))


def exact_filter(pairs: DataFrame, percent: int) -> DataFrame:
    """Rows of ``pairs(a, b, left, right)`` whose texts' sets reach the threshold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_set = None, frozenset()
        for batch in batches:
            keep = []
            for row, (left, right) in enumerate(zip(batch.column("left"), batch.column("right"))):
                text = left.as_py()
                if text != known:
                    known, known_set = text, shingle_set(text)
                other = shingle_set(right.as_py())
                small, large = len(known_set), len(other)
                if 100 * min(small, large) < percent * max(small, large):
                    continue
                both = len(known_set & other)
                if both and 100 * both >= percent * (small + large - both):
                    keep.append(row)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.mapInArrow(work, pairs.select("a", "b").schema)


def _attach(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """``a, b, left, right`` with the table's value of both ends; rows of one ``a`` come together."""
    side = table.select("id", value)
    half = pairs.join(side.withColumnsRenamed({"id": "b", value: "right"}), "b")
    return half.join(side.withColumnsRenamed({"id": "a", value: "left"}), "a").select("a", "b", "left", "right")


def block_links(rows: DataFrame, contents: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links ``(a, b)`` between different components of each bucket.

    ``rows(bucket, band, node, component, rows, shingles)``; ``contents(id, signature, text)``. A bucket of n blocks
    sends each row to n tasks; a pair is checked in the first band it shares, so no pair is checked twice.
    """
    steps = least_matches(percent, miss)
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    tiles = (
        rows.withColumn("blocks", blocks)
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "band", "node", "component", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .join(contents.withColumnRenamed("id", "node"), "node")
    )
    schema = T.StructType([T.StructField(n, rows.schema["node"].dataType) for n in ("a", "b")])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        nodes, comps = table.column("node").to_pylist(), table.column("component").to_pylist()
        _, comp = np.unique(np.array(comps), return_inverse=True)
        block = table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        band = table.column("band")[0].as_py()
        marks = np.frombuffer(text_buffers(table.column("signature"))[0].tobytes(), np.uint32).reshape(len(nodes), -1)
        data, ends = text_buffers(table.column("text"))
        starts, stops, offsets = H.word_spans(data, ends)
        words = H.word_hashes(data, starts, stops, _SEED, fold_case=True)
        sets = [
            np.unique(H.windows(words[lo:hi], int(min(SHINGLE, hi - lo)), _SEED)) for lo, hi in zip(offsets[:-1], offsets[1:])
        ]
        sizes = np.array([len(x) for x in sets])
        shingles, codes = np.unique(np.concatenate(sets), return_inverse=True)
        firsts = np.concatenate([[0], np.cumsum(sizes)])
        texts, links = table.column("text"), []
        right_rows = np.flatnonzero(block == j)
        for x in np.flatnonzero(block == i):
            other = right_rows[right_rows > x] if i == j else right_rows
            other = other[comp[other] != comp[x]]
            other = other[100 * np.minimum(sizes[other], sizes[x]) >= percent * np.maximum(sizes[other], sizes[x])]
            equal, at = np.zeros(len(other), np.int64), 0
            for n, least in steps:
                equal += (marks[other, at:n] == marks[x, at:n]).sum(axis=1)
                keep, at = equal >= least, n
                other, equal = other[keep], equal[keep]
            if not len(other):
                continue
            shared = (marks[other].reshape(len(other), -1, ROWS) == marks[x].reshape(-1, ROWS)).all(axis=2)
            other = other[shared.argmax(axis=1) == band]
            mine = np.zeros(len(shingles), bool)
            mine[codes[firsts[x] : firsts[x + 1]]] = True
            for y in other:
                both = int(mine[codes[firsts[y] : firsts[y + 1]]].sum())
                if 100 * both < percent * (sizes[x] + sizes[y] - both):
                    continue
                one, two = shingle_set(texts[int(x)].as_py()), shingle_set(texts[int(y)].as_py())
                if 100 * len(one & two) >= percent * len(one | two):
                    links.append(sorted((nodes[x], nodes[y])))
        return pa.table([pa.array([k[n] for k in links], table.column("node").type) for n in (0, 1)], names=["a", "b"])

    return tiles.groupBy("bucket", "i", "j").applyInArrow(compare, schema)


def by_size(ids: DataFrame) -> DataFrame:
    """A stored list of ids, marked for broadcast when its count allows, so that texts it meets need not be shuffled."""
    ids = scratch.store(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _same_id(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the classes of an id that has several texts."""
    texts = usable.select("id", "digest").distinct()
    several = texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    own = texts.join(several, "id").join(classes, "digest")
    hubs = own.groupBy("id").agg(F.min("rep").alias("a"))
    return own.join(hubs, "id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85, miss: float = 1e-6
) -> DataFrame:
    """Per row: ``id, n_shingles, component_id, kept``. The smallest id of a component stands for it and is kept."""
    rows = scratch.store(features(docs, id, text, bands_for(percent)), "shingles")
    usable = rows.where("n_shingles > 0 and id is not null")
    classes = scratch.store(usable.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    nodes = usable.join(classes.select(F.col("rep").alias("id"), "digest"), ["id", "digest"])
    spread = nodes.select(
        F.posexplode("bands").alias("band", "bucket"), F.col("id").alias("node"), F.col("n_shingles").alias("size")
    )
    shared = spread.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = scratch.store(spread.join(shared.select("bucket"), "bucket").distinct(), "members")

    touched = by_size(members.select(F.col("node").alias("id")).distinct())
    marks = scratch.store(usable.select("id", "signature").join(touched, "id"), "candidate-signatures")
    texts = scratch.store(
        docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(touched, "id"), "candidate-texts"
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        possible = bayes_filter(_attach(pairs, marks, "signature"), percent, miss).distinct()
        return scratch.store(exact_filter(_attach(possible, texts, "text"), percent), "confirmed")

    links = scratch.store(_same_id(usable, classes), "shared-ids")
    for turn in range(PIVOT_ROUNDS + 1):
        open_rows = members.withColumn("component", F.col("node"))
        if turn:
            labels = components(links)
            open_rows = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = open_rows.groupBy("bucket").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("rows"),
            F.sum("size").alias("shingles"),
            F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn)) if turn else F.col("node")).alias("pivot"),
        ).where("low < high")
        if turn < PIVOT_ROUNDS:
            pairs = (
                open_rows.join(split, "bucket")
                .where("component <> pivot.component")
                .groupBy("node").agg(F.min("pivot.node").alias("a"))
                .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
                .distinct()
            )
            fresh = confirmed(pairs)
        else:
            rest = open_rows.join(split.select("bucket", "rows", "shingles"), "bucket")
            fresh = scratch.store(block_links(rest, marks.join(texts, "id"), percent, miss), "block-links")
        links = links.union(fresh)
    labels = components(links).withColumnsRenamed({"node": "rep", "component": "reached"})
    return (
        rows.select("id", "n_shingles", "digest")
        .join(classes, "digest", "left")
        .join(labels, "rep", "left")
        .select(
            F.col("id").alias(id),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("reached", "rep", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85, miss: float = 1e-6) -> DataFrame:
    """``docs`` with the rows of one id of each component; of its rows with equal word sets only one, with the smallest
    text, stays. Rows without id all stay.

    Only rows whose id is dropped somewhere or repeated can go, so only they are looked at again.
    """
    judged = scratch.store(near_duplicates(docs, id, text, percent, miss).where(F.col(id).isNotNull()).select(id, "kept"), "judged")
    doubtful = by_size(judged.groupBy(id).agg(F.bool_and("kept").alias("sure"), F.count("*").alias("n")).where("not sure or n > 1").select(id))
    staying = judged.where("kept").select(id).join(doubtful, id, "left_semi").distinct()
    again = docs.join(doubtful, id, "left_semi").join(staying, id, "left_semi")
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("whole")
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    words = F.array_remove(F.split(folded, r"[\x20\x09-\x0D]+"), "")
    last = F.size(words) - (SHINGLE - 1)
    pieces = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    shingles = F.when(F.size(words) < SHINGLE, F.array(F.array_join(words, " "))).otherwise(F.array_sort(F.array_distinct(pieces)))
    content = F.sha2(F.array_join(shingles, "\n"), 256).alias("content")
    one = again.select(F.col(id).alias("own"), content, F.col(text).alias("text"), whole).groupBy("own", "content").agg(
        F.min_by("whole", F.coalesce("text", F.lit(""))).alias("whole")
    )
    return docs.join(doubtful, id, "left_anti").unionByName(one.select("whole.*"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
