"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Base rules look at a document alone. The method adds cutoffs on four ratios (``MEASURES``). A rule is one cutoff for each
measure, and rejects a document that is above any. For each stratum (language) the rules of ``STEPS``, each stricter than
the one before in one measure, are tried on the labelled documents: a rule would reject x of the n good ones, and it is
accepted when P(Binomial(n, alpha) <= x) <= delta / strata, the exact test that its false-rejection rate is below alpha.
Testing stops at the first rule that fails (a fixed sequence needs no correction of its own; the strata share delta by
Bonferroni). With probability 1 - delta the accepted rule of no stratum rejects more than a share ``alpha`` of its good
documents, over all measures together. Too few labels accept nothing, so nothing is rejected.

All labelled good documents are counted, at every size, copies of a text once: an aggregate of one row for each stratum.

Nulls and repeats: null text has no words and fails the base rules; a null language is a stratum of its own; documents
without label or with a null label take no part in the tests; a text labelled more than once counts once in its stratum.
Whole texts are judged, a text of any length in one row (its words must fit a task some thirty times over). Repeated documents are judged alike. Columns of the same name as a measure are not touched: only the named ones are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.sources import scratch

WORDS = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20

ALPHA = 0.01
DELTA = 0.05
#: measure -> cutoffs in the order they are tested; a document fails when its measure is above the accepted cutoff
MEASURES = {
    "symbol_ratio": (1.0, 0.5, 0.3, 0.2, 0.15, 0.1, 0.05),
    "dup_line_ratio": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeat_ratio": (0.18, 0.15, 0.12, 0.1, 0.08, 0.05, 0.02),
    "mean_word_chars": (40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 8.0),
}

#: the rules in the order they are tested: measure -> cutoff, one measure stricter at each step
STEPS = tuple(
    {name: MEASURES[name][rank if k <= at else rank - 1] for k, name in enumerate(MEASURES) if k <= at or rank}
    for rank in range(7)
    for at in range(len(MEASURES))
)


#: names of the work columns; an input column of such a name is replaced, all others are kept
WORK = ("quality_measures", "quality_stratum", "quality_limits", "quality_base_failed", "quality_kept")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words lying in a 5-word window that the text holds at least twice.

    Windows are compared by hash. Most texts repeat none, which a distinct count of the hashes shows; otherwise the
    (hash, place) pairs are sorted, those with an equal neighbour are repeated, and each place adds the words up to the
    next one, five at most.
    """
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(WINDOW)]))

    def covered(keys: Column) -> Column:
        pairs = F.sort_array(F.arrays_zip(keys.alias("h"), F.sequence(F.lit(1), F.size(keys)).alias("p")))

        def count(sorted_pairs: Column) -> Column:
            hash_at = lambda i: F.get(sorted_pairs, i)["h"]
            twice = F.filter(
                sorted_pairs,
                lambda x, i: (x["h"] == F.coalesce(hash_at(i + 1), x["h"] + 1))
                | ((i > 0) & (x["h"] == F.coalesce(hash_at(F.greatest(i - 1, F.lit(0))), x["h"] + 1))),
            )
            starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
            return let(
                starts,
                lambda s: F.aggregate(
                    F.transform(s, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - p, F.lit(WINDOW)))),
                    F.lit(0),
                    lambda a, x: a + x,
                ),
            )

        return let(pairs, count)

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(hashes, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(covered(k)))
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``quality_measures``: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines``
    and ``digest``, that of the text."""
    full = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(full, SPACES), lambda w: w != "")
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(WORDS))
    q = let(
        F.struct(words.alias("w"), lines.alias("l")),
        lambda s: F.struct(
            F.size(s["w"]).cast("long").alias("n_words"),
            F.length(F.array_join(s["w"], "")).cast("long").alias("word_chars"),
            F.regexp_count(full, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("long").alias("n_dup_lines"),
            _repeated(s["w"]).cast("long").alias("n_repeat_words"),
            F.size(s["l"]).cast("long").alias("n_lines"),
            F.md5(full.cast("binary")).alias("digest"),
        ),
    )
    return docs.withColumn("quality_measures", q)


def base_failed() -> Column:
    return (F.col("quality_measures.n_words") < LEAST_WORDS) | (100 * F.col("quality_measures.n_repeat_words") > MOST_REPEATED * F.col("quality_measures.n_words"))


def _ratio(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


RATIOS = {
    "symbol_ratio": lambda: _ratio("quality_measures.n_symbols", "quality_measures.n_words"),
    "dup_line_ratio": lambda: _ratio("quality_measures.n_dup_lines", "quality_measures.n_lines"),
    "repeat_ratio": lambda: _ratio("quality_measures.n_repeat_words", "quality_measures.n_words"),
    "mean_word_chars": lambda: _ratio("quality_measures.word_chars", "quality_measures.n_words"),
}


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= x). Terms follow from one another in logarithms, so large n do not underflow."""
    step = F.log(F.lit(p / (1 - p)))
    start = n * F.log(F.lit(1 - p))
    sums = F.aggregate(
        F.sequence(F.lit(0), x),
        F.struct(start.alias("term"), F.lit(0.0).alias("total")),
        lambda s, k: F.struct(
            (s["term"] + F.log((n - k) / (k + 1)) + step).alias("term"), (s["total"] + F.exp(s["term"])).alias("total")
        ),
    )
    return F.when(x >= n, F.lit(1.0)).otherwise(F.least(sums["total"], F.lit(1.0)))


def cutoffs(good: DataFrame, strata: int, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and one cutoff per measure (null: none accepted) from all labelled good rows ``(stratum, <measures>)``.

    More than alpha * n + 1 hits lie above the median of the binomial, so they fail at once and nothing is summed for them.
    """

    def rejects(rule: dict[str, float]) -> Column:
        return F.greatest(*[F.col(name) > value for name, value in rule.items()], F.lit(False))

    hits = good.groupBy("stratum").agg(F.count("*").alias("n"), *[F.count_if(rejects(r)).alias(f"x{k}") for k, r in enumerate(STEPS)])
    tests = [F.struct(F.lit(k).alias("step"), F.col(f"x{k}").alias("x")) for k in range(len(STEPS))]
    counted = hits.select("stratum", "n", F.inline(F.array(*tests)))
    possible = F.col("x") <= alpha * F.col("n") + 1
    summed = F.when(possible, F.col("x")).otherwise(F.lit(0).cast("long"))
    ok = possible & (binomial_cdf(summed, F.col("n"), alpha) <= F.lit(delta / max(1, strata)))
    accepted = counted.groupBy("stratum").agg(F.coalesce(F.min(F.when(~ok, F.col("step"))), F.lit(len(STEPS))).alias("accepted"))
    value = lambda name: F.array(*[F.lit(r.get(name)).cast("double") for r in STEPS])
    return accepted.where("accepted > 0").select(
        "stratum", *[F.get(value(name), F.col("accepted") - 1).alias(f"{name}_cutoff") for name in MEASURES]
    )


def limits_of(
    measured: DataFrame, labels: DataFrame, id: str, stratum: str, alpha: float, delta: float
) -> DataFrame:
    """The accepted cutoffs of each stratum, stored, from documents with ``quality_measures`` and their labels."""
    narrow = measured.select(F.col(id).alias("id"), _stratum(stratum).alias("stratum"), "quality_measures", "quality_measures.digest")
    ratios = narrow.withColumns({name: make() for name, make in RATIOS.items()})
    good = labels.where("quality = 1").select(F.col(id).alias("id"))
    labelled = ratios.where(~base_failed()).join(good, "id").dropDuplicates(["stratum", "digest"])
    strata = narrow.agg(F.count_distinct("stratum")).first()[0]
    return scratch.store(cutoffs(labelled, strata, alpha, delta), "cutoffs")


def _stratum(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("\0none"))


def verdicts(measured: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    """``measured`` with ``quality_base_failed`` and ``quality_kept``."""
    renamed = limits.select(
        F.col("stratum").alias("quality_stratum"),
        F.struct(*[F.col(f"{name}_cutoff").alias(name) for name in MEASURES]).alias("quality_limits"),
    )
    failed = F.lit(False)
    for name, make in RATIOS.items():
        failed = failed | F.coalesce(make() > F.col(f"quality_limits.{name}"), F.lit(False))
    return (
        measured.join(renamed, _stratum(stratum) == F.col("quality_stratum"), "left")
        .withColumn("quality_base_failed", base_failed())
        .withColumn("quality_kept", ~F.col("quality_base_failed") & ~failed)
        .drop("quality_stratum", "quality_limits")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """Per row: id, the five counts, ``base_failed``, ``kept``. ``labels``: id and ``quality`` (1 good)."""
    measured = scratch.store(measures(docs.select(id, text, stratum), text).drop(text), "measures")
    limits = limits_of(measured, labels, id, stratum, alpha, delta)
    return verdicts(measured, limits, stratum).select(
        id, "quality_measures.n_words", "quality_measures.word_chars", "quality_measures.n_symbols",
        "quality_measures.n_dup_lines", "quality_measures.n_repeat_words",
        F.col("quality_base_failed").alias("base_failed"), F.col("quality_kept").alias("kept"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns but those named in ``WORK``. The measured texts are stored once, not shuffled."""
    order = [c for c in docs.columns if c not in WORK]
    measured = scratch.store(measures(docs.select(*order), text), "measures")
    limits = limits_of(measured, labels, id, stratum, alpha, delta)
    return verdicts(measured, limits, stratum).where("quality_kept").select(*order)
