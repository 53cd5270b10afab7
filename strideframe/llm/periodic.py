"""Periodic runs of words: online dyadic square catching.

A run is a stretch of consecutive words that repeats with a smallest period and that no neighbouring word extends. Words
are appended to ``Catchers``. For the periods ``low .. 2 * low - 1`` (``low`` a power of two) every completed block of
``low / 2`` words is a catcher: the first half of a square of such a period holds a whole block, and the block comes again
one period later. So each appended word compares the suffix it completes with the one or two blocks that lie that far
back. Suffixes are compared by a name that doubles with the block size (64 bits). Equal blocks that follow one another at
one period are squares of one run and merge into a chain; a chain ends when its next block differs, and only then are its
two ends, less than a block away, looked up word by word. A chain that lies in a known run of a divisor of its period is
that run again and is dropped, and one too short for the asked exponent is never looked at. Appending n words
costs n log n comparisons, made as arrays over all words of an append.

The documents of an Arrow slice are one sequence, each closed by a word of its own, so no run crosses documents. Words are
named by 64-bit hashes; each run found is confirmed on the words themselves (a document that fails is numbered exactly
and searched again).

Whole texts are searched, one document never leaves its task: a document of n words takes about 100 bytes a word, so a
text of 100 MB needs about 2 GB of the worker. Nulls and repeats: a null or empty text has no words and no runs; a null id
is a row like any other; repeated rows each give their own row. Only the id and text columns are read, so other columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import hashing as H
from strideframe.llm.arrow import slices, text_buffers

EXPONENT = 4
LENGTH = 6
_SEED = 131


class _Level:
    """Catchers of the periods ``low .. 2 * low - 1``: names of all windows of one block size, from position ``at`` on."""

    def __init__(self, low: int):
        self.low, self.size = low, max(1, low // 2)
        self.at = 0
        self.names = np.zeros(0, np.uint64)
        self.factor = H.stream(_SEED + low, 1)[0] | np.uint64(1)
        self.chains = np.zeros((0, 3), np.int64)  # period, first block, last block

    @property
    def end(self) -> int:
        return self.at + len(self.names)

    def name(self, below: _Level | None, words: np.ndarray) -> int:
        """Name the windows that the words up to now complete; the first new one is returned."""
        first = self.end
        if self.size == 1:
            fresh = words[first:]
        else:
            half, last = self.size // 2, len(words) - self.size
            left = below.names[first - below.at : last + 1 - below.at]
            fresh = left * self.factor + below.names[first + half - below.at : last + 1 + half - below.at]
        self.names = np.concatenate([self.names, fresh])
        return first

    def catch(self, first: int) -> None:
        """Compare the windows from ``first`` on with the blocks a period of this level before them."""
        at = np.arange(max(first, self.low), self.end)
        found = []
        for back in range(self.low // self.size if self.low > 1 else 1):
            block = ((at - self.low) // self.size - back) * self.size
            start = int(np.searchsorted(block, 0))
            hit = start + np.flatnonzero(self.names[at[start:] - self.at] == self.names[block[start:] - self.at])
            found.append(np.stack([at[hit] - block[hit], block[hit], block[hit]], 1))
        chains = np.concatenate([self.chains, *found])
        chains = chains[np.lexsort((chains[:, 1], chains[:, 0]))]
        joined = np.zeros(len(chains), bool)
        joined[1:] = (chains[1:, 0] == chains[:-1, 0]) & (chains[1:, 1] == chains[:-1, 2] + self.size)
        heads = np.flatnonzero(~joined)
        tails = np.append(heads[1:], len(chains)) - 1 if len(heads) else heads
        self.chains = np.stack([chains[heads, 0], chains[heads, 1], chains[tails, 2]], 1)

    def trim(self) -> None:
        keep = max(self.at, self.end - 5 * self.low)
        self.names, self.at = self.names[keep - self.at :], keep


class Catchers:
    """Runs of at least ``exponent`` periods and ``length`` words in the words appended so far.

    ``most`` bounds the period, where a bound on the length of what can hold a run is known.
    """

    def __init__(self, exponent: int = 2, length: int = 0, most: int | None = None):
        self.exponent, self.length, self.most = max(2, exponent), length, most
        self._buffer, self._n = np.zeros(0, np.uint64), 0
        self._levels: list[_Level] = []
        self._found: list[tuple[int, int, int]] = []

    @property
    def words(self) -> np.ndarray:
        return self._buffer[: self._n]

    def append(self, words: np.ndarray) -> None:
        n = self._n + len(words)
        if n > len(self._buffer):
            room = np.zeros(max(n, 2 * len(self._buffer)), np.uint64)
            room[: self._n] = self.words
            self._buffer = room
        self._buffer[self._n : n] = words
        self._n = n
        below = None
        level = 0
        while (low := 1 << level) * 2 <= n and (self.most is None or low <= self.most):
            if level == len(self._levels):
                self._levels.append(_Level(low))
            own = self._levels[level]
            with np.errstate(over="ignore"):
                first = own.name(below, self.words)
            own.catch(first)
            # a chain is over when the block after its last one was compared
            over = own.chains[:, 2] + 2 * own.size + own.chains[:, 0] <= n
            self._found += self._look_up(own, own.chains[over], self._found)
            own.chains = own.chains[~over]
            below = own
            level += 1
        for own in self._levels:
            own.trim()

    def _look_up(self, level: _Level, chains: np.ndarray, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The maximal stretches of the chains that are long enough: ``(start, end, period)``."""
        size, n, words = level.size, self._n, self.words
        least = np.maximum((self.exponent - 1) * chains[:, 0], self.length - chains[:, 0])
        blocks = (chains[:, 2] - chains[:, 1]) // size + 1
        chains = chains[blocks >= np.maximum(1, (least - size + 1) // size)]
        if len(known) and len(chains):
            runs = np.array(known, np.int64)
            runs = runs[np.argsort(runs[:, 0], kind="stable")]
            farthest = np.maximum.accumulate(runs[:, 1])
            reach = np.maximum.accumulate(np.where(runs[:, 1] == farthest, np.arange(len(runs)), 0))
            place = np.searchsorted(runs[:, 0], chains[:, 1], "right") - 1
            over = runs[reach[np.maximum(place, 0)]]
            inside = (place >= 0) & (chains[:, 2] + size + chains[:, 0] <= over[:, 1]) & (chains[:, 0] % over[:, 2] == 0)
            chains = chains[~inside]
        out = []
        for q, first, last in chains.tolist():
            low, high = max(0, first - size), min(n - q, last + 2 * size)
            same = np.zeros(high - low + 2, np.int8)
            same[1:-1] = words[low:high] == words[low + q : high + q]
            edges = np.flatnonzero(np.diff(same)) + low
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - start >= (self.exponent - 1) * q and end - start + q >= self.length:
                    out.append((start, end + q, q))
        return out

    def runs(self) -> np.ndarray:
        """Rows ``start, end, period`` of the words so far, by start, then period; more words may still extend the last."""
        found = list(self._found)
        for level in self._levels:
            found += self._look_up(level, level.chains, found)
        rows = np.array(sorted(set(found)), np.int64).reshape(-1, 3)
        # the same stretch at a multiple of its period is the same run; sorting puts the smallest period first
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        rows = rows[fresh]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _sequence(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all documents with a closing word after each, and where each document starts."""
    n = len(offsets) - 1
    starts = offsets + np.arange(n + 1)
    out = np.empty(len(hashes) + n, np.uint64)
    closing = np.zeros(len(out), bool)
    closing[starts[1:] - 1] = True
    out[closing] = H.stream(_SEED, n)
    out[~closing] = hashes[: offsets[-1]]
    return out, starts


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.uint64)


def _confirmed(words: list[bytes], runs: np.ndarray, exponent: int, length: int) -> np.ndarray:
    if all(words[s : e - q] == words[s + q : e] for s, e, q in runs.tolist()):
        return runs
    exact = Catchers(exponent, length)
    exact.append(_numbered(words))
    return exact.runs()


def collapse_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", exponent: int = EXPONENT, length: int = LENGTH
) -> DataFrame:
    """Per row: ``id, n_words, runs, collapsed``.

    ``runs`` (``start, length, period`` in words, by start, then period) are those of at least ``exponent`` periods and
    ``length`` words; ``collapsed`` is the text with only the first period of every run, words joined by one space.
    """
    source = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType(
        [T.StructField(id, source.schema["id"].dataType), T.StructField("n_words", T.LongType()),
         T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            data, ends = text_buffers(batch.column("text"))
            starts, stops, offsets = H.word_spans(data, ends)
            sizes = np.diff(offsets)
            stream, first = _sequence(H.word_hashes(data, starts, stops, _SEED), offsets)
            catchers = Catchers(exponent, length, int(sizes.max(initial=0)) // max(2, exponent))
            catchers.append(stream)
            found = catchers.runs()
            owner = np.searchsorted(first, found[:, 0], "right") - 1
            raw = data.tobytes()
            own_starts, own_lengths, own_periods, counts, kept = [], [], [], [], []
            for row in range(batch.num_rows):
                words = raw[ends[row] : ends[row + 1]].split()
                mine = found[np.searchsorted(owner, row) : np.searchsorted(owner, row, "right")]
                counts.append(len(mine))
                if len(mine):
                    at = mine - np.array([first[row], first[row], 0])
                    at = _confirmed(words, at, exponent, length)
                    counts[-1] = len(at)
                    own_starts.append(at[:, 0])
                    own_lengths.append(at[:, 1] - at[:, 0])
                    own_periods.append(at[:, 2])
                    gone = np.zeros(len(words) + 1, np.int32)
                    np.add.at(gone, at[:, 0] + at[:, 2], 1)
                    np.add.at(gone, at[:, 1], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
                kept.append(b" ".join(words))
            columns = [pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for c in (own_starts, own_lengths, own_periods)]
            listed = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), listed, pa.array(kept, pa.binary()).cast(pa.string())],
                names=[id, "n_words", "runs", "collapsed"],
            )

    return source.mapInArrow(work, schema)
