"""Byte-level BPE over whole texts: class arrays, a transition-function scan, cached merges, exact decoding.

Pre-tokens are found without a regular expression. Every code point gets a symbol (letter, digit, other, white space,
and apostrophes that open a contraction) from its class and up to two code points of look-ahead. Each symbol is a
function on a few states; functions compose associatively, so a batch is cut into rows of ``_WIDTH`` symbols whose
functions are composed side by side, scanned over the rows, and then applied to give the state before every symbol.
A (state, symbol) table says where a token starts. Texts are separated by a symbol that resets the state, so one scan
serves a batch; very long texts are scanned in pieces that hand on their state.

A pre-token's ids are found by merging its bytes pair by pair, lowest rank first, and kept in a bounded cache.

Nulls: a null text is encoded as the empty text. Equal rows have equal ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strideframe.llm.arrow import slices, text_buffers

# symbols
LETTER, DIGIT, OTHER, APOS2, APOS3, SPACE_LAST, WHITE_LAST, WHITE, BREAK = range(9)
# states: before a text; in letters, digits, others; after a space that the next run may join; in white space; one and
# two code points of a contraction to come; a contraction just ended
FRESH, IN_LETTERS, IN_DIGITS, IN_OTHER, AFTER_SPACE, IN_WHITE, NEED1, NEED2, ENDED = range(9)
_STATES = 9
_WIDTH = 64

# fixed values: the Unicode property White_Space
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and token start for every (symbol, state)."""
    following = np.zeros((9, _STATES), np.uint8)
    starts = np.ones((9, _STATES), bool)
    run = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHER, APOS2: IN_OTHER, APOS3: IN_OTHER}
    for symbol, state in run.items():
        following[symbol] = state
        starts[symbol, [state, AFTER_SPACE]] = False
    for symbol, need in ((APOS2, NEED1), (APOS3, NEED2)):
        for state in range(_STATES):
            if starts[symbol, state]:
                following[symbol, state] = need
    following[LETTER, NEED1], following[LETTER, NEED2] = ENDED, NEED1
    starts[LETTER, [NEED1, NEED2]] = False
    following[SPACE_LAST], following[WHITE_LAST], following[WHITE] = AFTER_SPACE, IN_WHITE, IN_WHITE
    starts[WHITE, IN_WHITE] = False
    following[BREAK], starts[BREAK] = FRESH, False
    return following, starts


_NEXT, _START = _machine()


def _compositions() -> tuple[np.ndarray, np.ndarray]:
    """Every function that texts can compose from the symbols' functions, and the table of their compositions.

    Function 0 is the identity and function 1 + s that of symbol s; entry (f, g) of the table is "f, then g".
    """
    functions = [tuple(range(_STATES))] + [tuple(int(x) for x in row) for row in _NEXT]
    number: dict[tuple[int, ...], int] = {}
    for k, f in enumerate(functions):
        number.setdefault(f, k)
    at = 0
    while at < len(functions):
        for symbol in _NEXT:
            f = tuple(int(symbol[x]) for x in functions[at])
            if f not in number:
                number[f] = len(functions)
                functions.append(f)
        at += 1
    table = [[number[tuple(g[x] for x in f)] for g in functions] for f in functions]
    return np.array(functions, np.int16), np.array(table, np.int16)


_FUNCTIONS, _COMPOSED = _compositions()


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """LETTER, DIGIT, OTHER or WHITE for every code point, built once for each process.

    Which code points are letters and digits depends on the Unicode version, so the library whose ids are to be matched
    is asked: with single bytes as its vocabulary and one property as its pattern, it returns the code points that have it.
    """
    table = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
        lister = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        found = bytes(lister.encode_ordinary(text)).decode("utf-8")
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    table[list(WHITE_SPACE)] = WHITE
    return table


def symbols(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """The symbol of every code point; ``breaks`` marks separators between texts."""
    kind = _classes()[np.minimum(points, 0x10FFFF)]
    out = kind.copy()
    n = len(points)
    following = np.full(n, BREAK, np.uint8)
    following[:-1] = np.where(breaks[1:], BREAK, kind[1:])
    last = (kind == WHITE) & (following != WHITE) & (following != BREAK)
    out[last] = WHITE_LAST
    out[last & (points == 0x20)] = SPACE_LAST
    quote = np.flatnonzero((points == 0x27) & ~breaks)
    if len(quote):
        ahead = np.concatenate([points, np.zeros(2, points.dtype)])
        stop = np.concatenate([breaks, np.ones(2, bool)])
        one, two = ahead[quote + 1], ahead[quote + 2]
        near, far = ~stop[quote + 1], ~stop[quote + 1] & ~stop[quote + 2]
        out[quote[near & np.isin(one, [ord(c) for c in "stmd"])]] = APOS2
        pair = (
            ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        )
        out[quote[far & pair]] = APOS3
    out[breaks] = BREAK
    return out


def scan_starts(symbol: np.ndarray, state: int = FRESH) -> tuple[np.ndarray, int]:
    """Where tokens start, and the state after the last symbol."""
    n = len(symbol)
    rows = -(-n // _WIDTH)
    grid = np.full(rows * _WIDTH, BREAK, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, _WIDTH).T)
    composed, size = _COMPOSED.ravel(), len(_COMPOSED)
    # each row's function, composed column by column
    whole = np.zeros(rows, np.intp)
    for column in grid:
        whole *= size
        whole += column
        whole += 1
        whole = composed[whole].astype(np.intp)
    # inclusive scan over the rows by doubling, as composition is associative
    step = 1
    while step < rows:
        whole[step:] = composed[whole[:-step] * size + whole[step:]]
        step *= 2
    now = np.empty(rows, np.intp)
    now[0] = state
    now[1:] = _FUNCTIONS[whole[:-1], state]
    begin = np.empty(grid.shape, bool)
    starts, following = _START.ravel(), _NEXT.ravel()
    for k, column in enumerate(grid):
        now += column * np.intp(_STATES)
        begin[k] = starts[now]
        now = following[now].astype(np.intp)
    final = int(_FUNCTIONS[whole[rows - 2], state]) if rows > 1 else state
    for s in symbol[(rows - 1) * _WIDTH :]:
        final = int(_NEXT[s, final])
    return begin.T.ravel()[:n], final


_LEADS = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def token_starts(data: np.ndarray, ends: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Byte places where pre-tokens start, in the concatenated UTF-8 of texts with offsets ``ends``."""
    if not len(data):
        return np.zeros(0, np.int64)
    places = np.flatnonzero(_LEADS[data])
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    # a separator goes before every text that is not empty
    heads = np.searchsorted(places, np.unique(ends[:-1][ends[:-1] < ends[1:]]))
    where = heads + np.arange(len(heads))
    n = len(points) + len(heads)
    breaks = np.zeros(n, bool)
    breaks[where] = True
    spread = np.zeros(n, np.uint32)
    spread[~breaks] = points
    out, state = [], FRESH
    symbol = symbols(spread, breaks)
    for at in range(0, n, piece):
        begin, state = scan_starts(symbol[at : at + piece], state)
        out.append(begin)
    begin = np.concatenate(out)
    return places[begin[~breaks]]


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_NO_PAIR = 1 << 40


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - slots.bit_length())).astype(np.int64)


class _Merged(dict):
    """Ids of pre-tokens as native 32-bit integers, merged when first asked for; long ones are not kept."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.merge(piece), np.uint32).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Vocabulary:
    """Ranks of a vocabulary file, with merged pre-tokens kept until there are ``CACHE`` (looked at once a batch)."""

    CACHE = 100_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.none = len(ranks) + (1 << 30)
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.cache = _Merged(self.merge)

    @classmethod
    def parse(cls, content: bytes) -> Vocabulary:
        lines = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(piece): int(rank) for piece, rank in lines})

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: join the adjacent pair of lowest rank, leftmost first, until none is in the vocabulary."""
        get, none = self.ranks.get, self.none
        whole = get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 256:
            return self._merge_long(piece)
        # parts are piece[cut[i]:cut[i + 1]]; pair[i] is the rank of parts i and i + 1 joined
        cut = list(range(len(piece) + 1))
        pair = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        best = min(pair, default=none)
        while best != none:
            i = pair.index(best)
            del cut[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get(piece[cut[i] : cut[i + 2]], none)
            if i:
                pair[i - 1] = get(piece[cut[i - 1] : cut[i + 1]], none)
            best = min(pair, default=none)
        return tuple([get(piece[a:b]) for a, b in zip(cut, cut[1:])])

    def learn(self, pieces: set[bytes]) -> None:
        """Merge pre-tokens that are not kept yet, many at a time; long ones are left to :meth:`merge`."""
        fresh, cache, get = [], self.cache, self.ranks.get
        for piece in pieces:
            if len(piece) <= 64:
                whole = get(piece)
                if whole is None:
                    fresh.append(piece)
                else:
                    cache[piece] = whole.to_bytes(4, sys.byteorder)
        fresh.sort(key=len)
        for at in range(0, len(fresh), 4096):
            self._merge_many(fresh[at : at + 4096])

    @functools.cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash table with open addressing: (id, id) -> id of the joined bytes, for all pairs in the vocabulary."""
        get, keys, values = self.ranks.get, [], []
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                left, right = get(piece[:i]), get(piece[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        keys, values = np.array(keys, np.uint64), np.array(values, np.int64)
        slots = 1 << max(4, (4 * len(keys)).bit_length())
        table, held = np.full(slots, _EMPTY, np.uint64), np.full(slots, _NO_PAIR, np.int64)
        at = _slot(keys, slots)
        while len(keys):  # a key goes to the first free slot from its own on
            free = table[at] == _EMPTY
            table[at[free]] = keys[free]
            placed = table[at] == keys
            held[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & (slots - 1)
        return table, held

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of joined pairs (``_NO_PAIR`` where there is none, or an end is the padding -1)."""
        table, held = self._pairs
        keys = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        out = np.full(keys.shape, _NO_PAIR, np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[open_]
        at = _slot(keys, len(table))
        flat = out.ravel()
        while len(open_):
            found = table[at]
            same = found == keys
            flat[open_[same]] = held[at[same]]
            more = ~same & (found != _EMPTY)
            open_, keys, at = open_[more], keys[more], (at[more] + 1) & (len(table) - 1)
        return flat.reshape(out.shape)

    def _merge_many(self, pieces: list[bytes]) -> None:
        n, width = len(pieces), max(map(len, pieces)) + 1
        single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        ids = np.full((n, width), -1, np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        ids[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.where(ids >= 0, single[ids], -1)
        pair = self._joined(ids[:, :-1], ids[:, 1:])
        row, columns = np.arange(n), np.arange(width)
        live, live_ids, live_pair = row, ids, pair
        while len(live):
            spot = live_pair.argmin(axis=1)
            best = live_pair[np.arange(len(live)), spot]
            ended = best == _NO_PAIR
            if ended.any():
                ids[live[ended]] = live_ids[ended]
                live, live_ids, live_pair = live[~ended], live_ids[~ended], live_pair[~ended]
                spot, best = spot[~ended], best[~ended]
                if not len(live):
                    break
            at = np.arange(len(live))
            source = np.minimum(columns + (columns > spot[:, None]), width - 1)
            live_ids = np.take_along_axis(live_ids, source, axis=1)
            live_ids[:, -1] = -1
            live_ids[at, spot] = best
            live_pair = np.take_along_axis(live_pair, np.minimum(source[:, :-1], width - 2), axis=1)
            live_pair[:, -1] = _NO_PAIR
            live_pair[at, spot] = self._joined(live_ids[at, spot], live_ids[at, spot + 1])
            before = np.maximum(spot - 1, 0)
            left = self._joined(live_ids[at, before], live_ids[at, before + 1])
            live_pair[at, before] = left
        raw, wide = ids.astype(np.uint32).tobytes(), 4 * width
        stops = (np.arange(n) * wide + 4 * (ids >= 0).sum(axis=1)).tolist()
        self.cache.update(zip(pieces, [raw[k * wide : stop] for k, stop in enumerate(stops)]))

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap of pairs over a linked list, for pre-tokens of great length."""
        import heapq

        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        prev, following, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = following[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], alive[j], following[i] = stop, False, following[j]
            if following[i] < n:
                prev[following[i]] = i
                k = following[i]
                if (r := ranks.get(piece[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if prev[i] >= 0:
                p = prev[i]
                if (r := ranks.get(piece[p : end[i]])) is not None:
                    heapq.heappush(heap, (r, p, end[i]))
        return tuple(ranks[piece[i : end[i]]] for i in range(n) if alive[i])

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the n + 1 id offsets of the texts."""
        starts = token_starts(data, ends)
        raw, cache = data.tobytes(), self.cache
        if len(cache) > self.CACHE:
            cache.clear()
        cuts = starts.tolist()
        pieces = [raw[a:b] for a, b in zip(cuts, itertools.chain(cuts[1:], [len(raw)]))]
        self.learn(set(pieces).difference(cache))
        found = list(map(cache.__getitem__, pieces))
        before = np.zeros(len(found) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=before[1:])
        ids = np.frombuffer(b"".join(found), np.uint32)
        return ids, before[np.searchsorted(starts, ends)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))

    @functools.cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces], np.int64)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """The vocabulary of a file's content, parsed once for each worker."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _loaded:
        _loaded[key] = Vocabulary.parse(content)
    return _loaded[key]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:  # a file of the library that holds it, on the driver; its content goes to the workers
        return file.read()


def _with(docs: DataFrame, *fields: T.StructField) -> T.StructType:
    made = {f.name for f in fields}
    return T.StructType([f for f in docs.schema.fields if f.name not in made] + list(fields))


#: what :func:`encode` can add to a row
FIELDS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "token_offsets": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "decoded": (T.BinaryType(), pa.binary()),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded_sha256": (T.StringType(), pa.string()),
    "n_tokens": (T.LongType(), pa.int64()),
}


def encode(
    docs: DataFrame, content: bytes, text: str = "text", add: Sequence[str] = ("ids", "token_offsets"), drop: Sequence[str] = ()
) -> DataFrame:
    """``docs`` without the columns ``drop`` and with those of ``FIELDS`` that ``add`` names (replacing equal names).

    ``ids``; ``token_offsets``, the byte offset of every token in the text's UTF-8; ``decoded``, the bytes that the ids
    decode to; SHA-256 of the ids as little-endian unsigned 32-bit integers and of the decoded bytes. A row's results are
    made in one worker, so only what is asked for leaves it. ``content`` is the vocabulary file (under 1 MB).
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)
    kept = [f for f in docs.schema.fields if f.name not in add and f.name not in drop]
    schema = T.StructType(kept + [T.StructField(n, FIELDS[n][0]) for n in add])

    def results(words: Vocabulary, part: pa.Array) -> dict[str, pa.Array]:
        ids, cuts = words.encode(*text_buffers(part))
        made: dict[str, pa.Array] = {}
        rows = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        places = pa.array(cuts.astype(np.int32))
        if "ids" in add:
            made["ids"] = pa.ListArray.from_arrays(places, pa.array(ids.astype(np.int32)))
        if "n_tokens" in add:
            made["n_tokens"] = pa.array(np.diff(cuts))
        if "token_offsets" in add:
            sums = np.concatenate([[0], np.cumsum(words.lengths[ids])])
            offsets = sums[:-1] - np.repeat(sums[cuts[:-1]], np.diff(cuts))
            made["token_offsets"] = pa.ListArray.from_arrays(places, pa.array(offsets.astype(np.int32)))
        if "ids_sha256" in add:
            raw = ids.astype("<u4")
            made["ids_sha256"] = pa.array([hashlib.sha256(raw[a:b].data).hexdigest() for a, b in rows], pa.string())
        if "decoded" in add or "decoded_sha256" in add:
            decoded = [words.decode(ids[a:b]) for a, b in rows]
            made["decoded"] = pa.array(decoded, pa.binary())
            made["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())
        return made

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        for batch in slices(batches, text, 1 << 19):
            made = results(words, batch.column(text))
            yield pa.RecordBatch.from_pydict({f.name: made[f.name] if f.name in add else batch.column(f.name) for f in schema})
        pa.default_memory_pool().release_unused()  # the worker may serve other stages

    return docs.mapInArrow(work, schema)


def id_arrays(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    """The lists of a column as numpy arrays."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        yield values[a:b] if column[row].is_valid else None


def decode(encoded: DataFrame, content: bytes) -> DataFrame:
    """``encoded`` with ``decoded`` (the bytes of ``ids``; null ids give null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(content)
    schema = _with(encoded, T.StructField("decoded", T.BinaryType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [None if v is None else words.decode(v) for v in id_arrays(part.column("ids"))]
                columns = {f.name: part.column(f.name) for f in schema if f.name != "decoded"}
                yield pa.RecordBatch.from_pydict(columns | {"decoded": pa.array(made, pa.binary())})

    return encoded.mapInArrow(work, schema)
