"""Benchmark passages in documents by winnowing, in DataFrame functions only.

A window is ``SIZE`` consecutive words of a benchmark item, or the whole item where it is shorter. For windows of L words,
every (L + 1) / 2 words (rounded down) have a hash, and a window's fingerprint is the smallest hash in it. Equal windows
have equal fingerprints, so a passage of L or more shared words always shares one; and as neighbouring windows mostly
share theirs, a text keeps about one fingerprint for each quarter of a window, with the words of the windows it stands
for. Fingerprints of documents meet those of the benchmark (the only join that sees all documents; Spark broadcasts the
benchmark side when it is below its threshold, and shuffles and splits hot keys otherwise). A hit is then extended: the
windows it stands for are compared word by word with the benchmark's. Lengths below ``SIZE`` are looked for only if an
item has them.

Items of a window are listed for each different set of windows, not for each document, so a passage that many items and
many documents hold does not multiply.

Nulls and repeats: null or empty text has no words and no hits; rows of equal id and text are judged alike, each in its
own row; an item with a null id hits, but cannot be named or counted; items that share an id count as one. A document's words must fit
a task some fifty times over; texts of some ten million words need larger executors. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.llm.quality import let
from strideframe.sources import scratch

SIZE = 10
#: what parts words once A-Z are lower-cased, and the words of a text as it is
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUNS = "array<struct<length:int,start:int,print:bigint,span:string>>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN), "")


def fingerprints(words: Column, length: int) -> Column:
    """For each start of a window of ``length`` words (as many as ``words`` has, at least), its fingerprint."""
    gram = (length + 1) // 2
    width = length - gram + 1
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - gram), lambda i: F.xxhash64(F.lit(length), *[F.get(words, i + k) for k in range(gram)])
    )
    if width == 1:
        return hashes
    return let(
        hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.array_min(F.slice(h, i, F.lit(width))))
    )


def kept(words: Column, length: int) -> Column:
    """The fingerprints a text keeps: for each stretch of window starts with one fingerprint, ``length, start`` (from 0),
    ``print`` and the words of its windows."""

    def stretches(prints: Column) -> Column:
        heads = F.filter(
            F.sequence(F.lit(0), F.size(prints) - 1), lambda i: (i == 0) | (F.get(prints, i) != F.get(prints, F.greatest(i - 1, F.lit(0))))
        )
        return let(
            heads,
            lambda h: F.transform(
                h,
                lambda at, k: F.struct(
                    F.lit(length).alias("length"),
                    at.alias("start"),
                    F.get(prints, at).alias("print"),
                    F.array_join(F.slice(words, at + 1, F.coalesce(F.get(h, k + 1), F.size(prints)) - at + (length - 1)), " ").alias("span"),
                ),
            ),
        )

    return F.when(F.size(words) >= length, let(fingerprints(words, length), stretches)).otherwise(F.array().cast(_RUNS))


def _windows(span: Column, length: Column) -> Column:
    """Each window of a span: its place in the span and its words."""
    return let(
        F.split(span, " "),
        lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - length),
            lambda i: F.struct(i.alias("place"), F.array_join(F.slice(w, i + 1, length), " ").alias("window")),
        ),
    )


def benchmark_windows(items: DataFrame, size: int = SIZE, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, length, print, window, window_id`` of every window of every item, stored."""
    worded = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    parts = F.lit(None).cast(_RUNS)
    for length in range(size, 0, -1):
        fits = F.size("words") >= size if length == size else F.size("words") == length
        parts = F.when(fits, kept(F.col("words"), length)).otherwise(parts)
    runs = worded.select("item", F.inline(parts))
    windows = runs.select("item", "length", "print", F.explode(_windows(F.col("span"), F.col("length")).getField("window")).alias("window"))
    return scratch.store(windows.distinct().withColumn("window_id", F.md5(F.col("window").cast("binary"))), "benchmark-windows")


def _key(id: str, text: str) -> Column:
    """Rows with one key have equal ids and texts."""
    return F.md5(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("\0none")), F.lit("\0"), F.coalesce(F.col(text), F.lit(""))).cast("binary"))


def hits(docs: DataFrame, windows: DataFrame, size: int = SIZE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, at, length, window_id``: the word from which each benchmark window occurs in each document."""
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most ``size`` of them
    words = words_of(F.col(text))
    runs = let(words, lambda w: F.concat(F.array().cast(_RUNS), *[kept(w, n) for n in lengths]))
    found = docs.select(_key(id, text).alias("key"), F.inline(runs))
    found = found.join(windows.select("print").distinct(), "print", "left_semi")
    extended = found.select("key", "start", "length", F.inline(_windows(F.col("span"), F.col("length"))))
    own = windows.select("window", "window_id").distinct()
    return extended.join(own, "window").select("key", (F.col("start") + F.col("place")).alias("at"), "length", "window_id")


def _covered(places: Column) -> Column:
    """How many words lie in the stretches ``(at, length)``, sorted by ``at``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        places,
        zero,
        lambda s, p: F.struct(
            F.greatest(s["end"], p["at"] + p["length"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), p["at"] + p["length"] - F.greatest(s["end"], p["at"]))).alias("n"),
        ),
        lambda s: s["n"].cast("long"),
    )


def contamination(
    docs: DataFrame, items: DataFrame, size: int = SIZE, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document: ``id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts words inside an occurrence of a benchmark window, ``n_items`` the items with such windows; the digest
    is over their ids, sorted as strings and joined by commas.
    """
    docs = docs.select(id, F.col(text).cast("string").alias(text))
    windows = benchmark_windows(items, size, item_id, item_text)
    found = hits(docs, windows, size, id, text)
    per_key = found.groupBy("key").agg(
        F.collect_set(F.struct("at", "length")).alias("places"), F.array_sort(F.collect_set("window_id")).alias("window_ids")
    )
    judged = scratch.store(
        per_key.select(
            "key", _covered(F.array_sort("places")).alias("n_hit"), "window_ids",
            F.md5(F.array_join("window_ids", ",").cast("binary")).alias("set_id"),
        ),
        "contaminated",
    )
    members = judged.select("set_id", "window_ids").dropDuplicates(["set_id"]).select("set_id", F.explode("window_ids").alias("window_id"))
    named = members.join(windows.select("window_id", "item").distinct(), "window_id").groupBy("set_id").agg(
        F.array_sort(F.collect_set("item")).alias("named")
    )
    named = named.select("set_id", F.size("named").cast("long").alias("n_items"), F.sha2(F.array_join("named", ","), 256).alias("items_sha256"))
    results = judged.select("key", "n_hit", "set_id").join(named, "set_id").drop("set_id")
    counted = docs.select(
        F.col(id), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("n_words"), _key(id, text).alias("key")
    )
    return counted.join(results, "key", "left").select(
        id, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
