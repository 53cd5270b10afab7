"""Remove repeated passages: every window of ``SIZE`` words that also starts earlier loses its words.

A word is removed when some window covering it has an equal window at a smaller (doc_id, start). Windows are judged on
the input. Two passes:

1. Count-min prefilter. Each window is represented by its anchor, the smallest hash among its ``GRAM``-word grams; equal
   windows have equal anchors at equal places, so the number of places of an anchor is never below the number of places
   of a window. Each input partition counts its anchor places in a sketch of two rows of cells, sends only the cells it
   touched (sorted, compressed), and the sketches are merged by cell range. What is kept is one bit a cell: counted
   twice or more. Its size is fixed by ``cell_bits`` (at most 2 x 2^27 bits, 32 MB), so it can be broadcast.
2. Windows whose anchor is repeated by both rows go on, all others are unique for certain. A partition keeps the earliest
   place of each window and knows its later places to be repeats at once, so a window that is in a third of all
   documents sends one row for each partition chunk. Then the earliest place of each window over all chunks is found,
   and the other places go back to their documents.

Beyond about 2^27 anchors the prefilter passes more unique windows on; the second pass stays exact.
Windows are compared by 96 bits of hash.

Nulls and repeats: null text has no words; a row without id has no place in the order, loses nothing and is nobody's
earlier copy; rows that share an id count as the same document at the same place, so they do not remove each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import hashing as H
from strideframe.llm.arrow import slices, text_buffers

SIZE = 20
GRAM = 10
LEAST_BITS, MOST_BITS = 16, 27
#: cells of one merge task, as a power of two
RANGE_BITS = 20
#: windows a task gathers before it sends them on
CHUNK = 2_000_000
_SEED = 23


def _words(batch: pa.RecordBatch, seed: int) -> tuple[np.ndarray, np.ndarray]:
    data, ends = text_buffers(batch.column("text"))
    starts, stops, offsets = H.word_spans(data, ends)
    return H.word_hashes(data, starts, stops, seed), offsets


def anchors(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts that lie in one document, and the place and hash of each one's anchor (leftmost smallest gram)."""
    gram = min(GRAM, size)
    grams = H.windows(words, gram, _SEED)
    n = len(words) - size + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    span = size - gram + 1

    def smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)  # the left one when equal

    best, width = np.arange(len(grams)), 1
    while 2 * width <= span:
        best, width = smaller(best[:-width], best[width:]), 2 * width
    if span > width:
        best = smaller(best[: n], best[span - width : span - width + n])
    starts = np.flatnonzero(H.within(offsets, size, n))
    places = best[starts]
    return starts, places, grams[places]


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each hash in the two rows of the sketch, from different bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)


def _pack(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells of one range and whether each was counted more than once."""
    steps = np.diff(cells, prepend=0).astype("<u4")
    return zlib.compress(len(cells).to_bytes(4, "little") + steps.view(np.uint8).reshape(-1, 4).T.tobytes() + np.packbits(twice).tobytes(), 1)


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(raw)
    n = int.from_bytes(data[:4], "little")
    steps = np.frombuffer(data, np.uint8, 4 * n, 4).reshape(4, n).T.copy().view("<u4").ravel()
    twice = np.unpackbits(np.frombuffer(data, np.uint8, -1, 4 + 4 * n), count=n).astype(bool)
    return np.cumsum(steps.astype(np.int64)), twice


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text"))


def sketch(docs: DataFrame, id: str, text: str, size: int, bits: int) -> list[np.ndarray]:
    """The merged sketch: for each row, one bit a cell, set where the cell was counted twice or more."""
    range_bits = min(RANGE_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send() -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate(held)
            held.clear()
            for row, cells in enumerate(_cells(hashes, bits)):
                cells, counts = np.unique(cells, return_counts=True)
                parts = cells >> range_bits
                edges = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
                numbers, blobs = [], []
                for a, b in zip(edges[:-1], edges[1:]):
                    numbers.append(row << 32 | int(parts[a]))
                    blobs.append(_pack(cells[a:b] & ((1 << range_bits) - 1), counts[a:b] > 1))
                yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int64()), "cells": pa.array(blobs, pa.binary())})

        for batch in slices(batches, "text"):
            words, offsets = _words(batch, _SEED)
            _, places, hashes = anchors(words, offsets, size)
            fresh = np.diff(places, prepend=-1) != 0  # windows that follow one another mostly share their anchor
            held.append(hashes[fresh])
            if sum(map(len, held)) > CHUNK:
                yield from send()
        if held:
            yield from send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: np.ndarray | None = None
        part = None

        def bitmap() -> pa.RecordBatch:
            packed = np.packbits(seen > 1).tobytes()
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "cells": pa.array([zlib.compress(packed, 1)], pa.binary())})

        for batch in batches:
            for number, raw in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                if number != part:
                    if part is not None:
                        yield bitmap()
                    part, seen = number, np.zeros(1 << range_bits, np.uint8)
                cells, twice = _unpack(raw)
                seen[cells] = np.minimum(seen[cells] + 1 + twice, 2)
        if part is not None:
            yield bitmap()

    partial = _texts(docs, id, text).where("id is not null").mapInArrow(count, "part long, cells binary")
    merged = partial.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part long, cells binary")
    out = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(2)]
    width = (1 << range_bits) // 8
    for number, raw in merged.toLocalIterator():  # at most 2 x 2^bits bits in all
        at = (number & 0xFFFFFFFF) * width
        out[number >> 32][at : at + width] = np.frombuffer(zlib.decompress(raw), np.uint8)
    return out


def _repeated(bitmaps: list[np.ndarray], hashes: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(hashes), bool)
    for bitmap, cells in zip(bitmaps, _cells(hashes, bits)):
        ok &= (bitmap[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    return ok


def _tags(batch: pa.RecordBatch) -> np.ndarray:
    """31 bits of each text's hash, to tell apart rows that share an id."""
    return np.array([zlib.crc32(v.as_buffer() or b"") & 0x7FFFFFFF if v.is_valid else 0 for v in batch.column("text")], np.int64)


def repeated_places(docs: DataFrame, id: str, text: str, size: int, bits: int) -> DataFrame:
    """``(id, place, run)``: window starts that are not the first of their content; ``run`` starts in a row.

    ``place`` holds the row's tag in its upper and the start in its lower 32 bits.
    """
    shared = docs.sparkSession.sparkContext.broadcast([b.tobytes() for b in sketch(docs, id, text, size, bits)])
    source = _texts(docs, id, text).where("id is not null")
    id_type = source.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType()), T.StructField("id", id_type),
         T.StructField("place", T.LongType()), T.StructField("run", T.IntegerType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b, np.uint8) for b in shared.value]
        held: list[tuple] = []
        kept_ids: list[pa.Array] = []
        rows = [0]

        def send() -> Iterator[pa.RecordBatch]:
            h1, h2, doc, place = (np.concatenate([h[k] for h in held]) for k in range(4))
            ids = pa.concat_arrays(kept_ids)
            held.clear(), kept_ids.clear()
            rows[0] = 0
            rank = np.empty(len(ids), np.int64)  # documents in id order; equal ids share a rank
            order = np.asarray(pc.sort_indices(ids))
            ordered = ids.take(pa.array(order))
            steps = pc.not_equal(ordered[1:], ordered[:-1]).to_numpy(zero_copy_only=False)
            rank[order] = np.concatenate([[0], np.cumsum(steps)]) if len(order) else 0
            start = place & 0xFFFFFFFF
            by = np.lexsort((start, rank[doc], h2, h1))
            same = np.zeros(len(by), bool)
            same[1:] = (h1[by][1:] == h1[by][:-1]) & (h2[by][1:] == h2[by][:-1])
            lead = np.maximum.accumulate(np.where(~same, np.arange(len(by)), 0))
            at_first = (rank[doc[by]] == rank[doc[by[lead]]]) & (start[by] == start[by[lead]])
            first, later = np.sort(by[at_first]), np.sort(by[~at_first])
            run_first = np.ones(len(later), bool)
            run_first[1:] = (doc[later][1:] != doc[later][:-1]) | (place[later][1:] != place[later][:-1] + 1)
            heads = np.flatnonzero(run_first)
            lengths = np.diff(np.append(heads, len(later)))
            later = later[heads]
            take = np.concatenate([first, later])
            run = np.concatenate([np.zeros(len(first), np.int32), lengths.astype(np.int32)])
            for a in range(0, len(take), 200_000):
                some = take[a : a + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1[some].view(np.int64)), pa.array(h2[some]), ids.take(pa.array(doc[some])), pa.array(place[some]),
                     pa.array(run[a : a + 200_000])], schema=_arrow_schema(ids.type),
                )

        for batch in slices(batches, "text"):
            data, ends = text_buffers(batch.column("text"))
            starts_b, stops_b, offsets = H.word_spans(data, ends)
            words = H.word_hashes(data, starts_b, stops_b, _SEED)
            starts, _, hashes = anchors(words, offsets, size)
            starts = starts[_repeated(bitmaps, hashes, bits)]
            if not len(starts):
                continue
            others = H.word_hashes(data, starts_b, stops_b, _SEED + 1)
            doc = np.searchsorted(offsets, starts, "right") - 1
            place = (_tags(batch)[doc] << 32) | (starts - offsets[doc])
            base = sum(map(len, kept_ids))
            h1 = H.windows(words, size, _SEED + 2)[starts]
            h2 = H.windows(others, size, _SEED + 3)[starts].astype(np.uint32).view(np.int32)
            held.append((h1, h2, doc + base, place))
            kept_ids.append(batch.column("id"))
            rows[0] += len(starts)
            if rows[0] > CHUNK:
                yield from send()
        if held:
            yield from send()

    found = source.mapInArrow(work, schema)
    # a known repeat (run > 0) needs no partner: its own document spreads it
    key = F.when(F.col("run") > 0, F.xxhash64("id", "place")).otherwise(F.col("h1"))
    start = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    group = Window.partitionBy("key", "h2", F.col("run") > 0).orderBy("id", start)
    return (
        found.withColumn("key", key)
        .withColumn("turn", F.rank().over(group))
        .where("run > 0 or turn > 1")
        .select("id", "place", F.greatest("run", F.lit(1)).alias("run"))
    )


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("id", id_type), ("place", pa.int64()), ("run", pa.int32())])


def bits_for(docs: DataFrame, text: str) -> int:
    """Cells enough for about a tenth of them to be used: an anchor comes about every 30 bytes."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, int(size * 10 // 30).bit_length()))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, bits: int | None = None) -> DataFrame:
    """Per row: ``id, n_words, n_removed, kept_text`` (the kept words joined by one space)."""
    bits = bits or bits_for(docs, text)
    places = repeated_places(docs, id, text, size, bits).groupBy("id").agg(F.collect_list(F.struct("place", "run")).alias("places"))
    source = _texts(docs, id, text)
    schema = T.StructType(
        [T.StructField(id, source.schema["id"].dataType), T.StructField("n_words", T.LongType()),
         T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tags = _tags(batch)
            counts, removed, kept = [], [], []
            starts = batch.column("starts")
            for row, value in enumerate(batch.column("text")):
                words = (value.as_py() or "").encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(words) + 1, np.int32)
                if starts[row].is_valid:
                    own = starts[row].values
                    place, run = own.field("place").to_numpy(), own.field("run").to_numpy()
                    mine = (place >> 32) == tags[row]
                    first = place[mine] & 0xFFFFFFFF
                    np.add.at(gone, first, 1)
                    np.add.at(gone, first + run[mine] + size - 1, -1)
                cut = np.cumsum(gone)[:-1] > 0
                counts.append(len(words))
                removed.append(int(cut.sum()))
                left = words if not removed[-1] else [words[k] for k in np.flatnonzero(~cut)]
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[id, "n_words", "n_removed", "kept_text"],
            )

    joined = source.join(places.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    return joined.select("id", "text", F.col("places").alias("starts")).mapInArrow(work, schema)
