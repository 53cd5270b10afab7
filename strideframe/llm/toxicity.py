"""Toxicity by a weighted finite-state grammar over clauses.

Tokens are mapped to classes (insult, threat, target, negation, report, clause end, sentence end, other). Five small
transducers read the classes: the core one marks insults and threats, the others mark tokens in the scope of a target, a
negation or a reporting verb. Their composition is one table, built once; a text is read forwards, and backwards for
targets that follow. Each clause yields at most one match, its heaviest, labelled with the core and its context.

The lexicon and its weights are learnt from labelled rows only, in one aggregate over all of them: every word and every
word beginning (``BEGINNINGS`` letters) is counted in toxic and other documents. A word or beginning joins the listed
insults when ``LEAST_SUPPORT`` toxic documents hold it, its smoothed log-odds reach ``LEAST_ODDS``, and a Chernoff bound
on its count, times the number of terms tested, is at most ``FALSE_TERMS``, so about that many are expected by chance
at any size. The evidence alone decides, and every such term is kept; every task holds them all, so their number is checked
against ``MOST_TERMS`` (about 100 bytes each) and a greater one is an error that asks for more support. The weight of a term
is its log-odds; a listed term never seen in training keeps ``PRIOR``. A logistic regression on the summed clause weights
of each label gives the score. It is fitted on about ``FIT_ROWS`` rows (all, if fewer), by hash of the id.
Labels, language, source and id are never inputs of a score.

Copies of a text count as often as they are labelled. Of terms of one weight in a clause, the one with the greatest label
number counts. A text of any length is read whole, in one task. Nulls and repeats: a null or empty text has no clauses and gets the base score; a row without id is not held out and
takes no part in training; rows with a null label are not used; a document labelled twice counts for each label row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.sources import scratch

FIT_ROWS = 50_000
PRIOR = 2.0
PREDICT_AT = 0.7

BEGINNINGS = range(3, 9)
LEAST_SUPPORT, LEAST_ODDS, FALSE_TERMS = 3, 2.0, 1.0
MOST_TERMS = 2_000_000
#: terms a task counts, and words it remembers, before it starts anew
COUNTED = 200_000

# fixed values: the listed terms of the grammar
INSULTS = (
    "idiot", "idiots", "moron", "morons", "imbecile", "stupid", "dumb", "dumbass", "loser", "losers", "clown", "clowns",
    "pathetic", "worthless", "disgusting", "scum", "trash", "garbage", "filth", "vermin", "coward", "liar", "retard", "retarded",
    "bastard", "bitch", "asshole", "pig", "freak", "creep", "degenerate", "dummkopf", "trottel", "arschloch", "abschaum",
    "widerlich", "connard", "abruti", "crétin", "débile", "imbécile", "estúpido", "gilipollas", "basura", "asqueroso",
)
THREATS = ("kill", "murder", "hurt", "destroy", "strangle", "shoot", "stab", "töten", "umbringen", "tuer", "matar", "matarte")
TARGETS = (
    "you", "your", "yours", "you're", "youre", "u", "ur", "they", "them", "their", "he", "she", "him", "her", "everyone",
    "du", "dich", "dein", "ihr", "euch", "tu", "toi", "vous", "eres", "usted", "ustedes",
)
NEGATIONS = ("not", "never", "no", "isn't", "isnt", "aren't", "don't", "without", "nicht", "kein", "keine", "niemals", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "claimed", "claims", "reported", "quoted", "called", "alleged", "sagte", "schrieb", "dit", "dijo")

TERMS = INSULTS + THREATS
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, CLAUSE, SENTENCE = range(8)
_CLASS = (
    {w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS}
    | {w: INSULT for w in INSULTS} | {w: THREAT for w in THREATS}
    | {c: CLAUSE for c in ",;:"} | {c: SENTENCE for c in ".!?\n"}
)
_CORE = frozenset(TERMS)
_NUMBER = {w: n for n, w in enumerate(TERMS)}
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W\d_]+)?|[.!?;,:\n]")

#: tokens that a target or a negation reaches
TARGET_SCOPE, NEGATION_SCOPE = 4, 3

Machine = tuple[int, dict[tuple[int, int], tuple[int, tuple]]]  # states, (state, class) -> (state, output)


def scope(opens: int, length: int) -> Machine:
    """Marks the ``length`` tokens after one of class ``opens``; a clause or sentence end closes the scope."""
    arcs = {}
    for state in range(length + 1):
        for kind in range(8):
            after = length if kind == opens else 0 if kind in (CLAUSE, SENTENCE) else max(0, state - 1)
            arcs[state, kind] = (after, (state > 0,))
    return length + 1, arcs


def reported() -> Machine:
    """Marks everything after a reporting verb up to the sentence end."""
    arcs = {(s, k): (1 if k == REPORT else 0 if k == SENTENCE else s, (bool(s),)) for s in (0, 1) for k in range(8)}
    return 2, arcs


def core() -> Machine:
    return 1, {(0, k): (0, (k if k in (INSULT, THREAT) else 0,)) for k in range(8)}


def compose(one: Machine, two: Machine) -> Machine:
    """Both machines reading the same tokens: states are pairs, outputs are joined."""
    arcs = {}
    for a in range(one[0]):
        for b in range(two[0]):
            for kind in range(8):
                (a2, out), (b2, more) = one[1][a, kind], two[1][b, kind]
                arcs[a * two[0] + b, kind] = (a2 * two[0] + b2, out + more)
    return one[0] * two[0], arcs


_FORWARD = compose(compose(compose(core(), scope(TARGET, TARGET_SCOPE)), scope(NEGATION, NEGATION_SCOPE)), reported())[1]
_BACKWARD = scope(TARGET, TARGET_SCOPE)[1]

#: labels of a match: core kind x context; a reported or negated match is no longer told apart by its target
#: a learnt term reads as an insult, but is less sure, so its matches have labels of their own
LABELS = tuple(f"{kind}_{context}" for kind in ("insult", "threat", "learnt") for context in ("bare", "target", "negated", "reported"))


class Lexicon:
    """The terms of the grammar: the listed ones and ``learnt`` ones, a beginning written with a star at its end."""

    def __init__(self, learnt: tuple[str, ...] = (), weights: tuple[float, ...] = ()):
        self.learnt = {term: len(TERMS) + n for n, term in enumerate(learnt)}
        self.weights = weights or (PRIOR,) * (len(TERMS) + len(learnt))
        self.lengths = sorted({len(term) - 1 for term in learnt if term.endswith("*")}, reverse=True)
        self.known: dict[str, int | None] = {}

    def number(self, token: str) -> int | None:
        """The term a token is: a listed one, a learnt word, or the longest learnt beginning."""
        if token in _CLASS:
            return _NUMBER.get(token)
        if not self.learnt:
            return None
        try:
            return self.known[token]
        except KeyError:
            pass
        found = self.learnt.get(token)
        if found is None:
            starts = (self.learnt.get(token[:n] + "*") for n in self.lengths if n < len(token))
            found = next((n for n in starts if n is not None), None)
        if len(self.known) >= COUNTED:
            self.known.clear()
        self.known[token] = found
        return found


_LISTED = Lexicon()


def matches(text: str, lexicon: Lexicon = _LISTED) -> list[list[tuple[int, int]]]:
    """For each clause with a match, its (term, label) pairs."""
    tokens = _TOKEN.findall(text.lower())
    if lexicon.learnt:
        terms = {t: n for t in set(tokens) if (n := lexicon.number(t)) is not None}
    else:
        terms = {} if _CORE.isdisjoint(tokens) else _NUMBER
    if not terms:
        return []
    kinds = [_CLASS.get(t, INSULT if t in terms else OTHER) for t in tokens]
    ahead, state = [False] * len(kinds), 0
    for k in range(len(kinds) - 1, -1, -1):
        state, out = _BACKWARD[state, kinds[k]]
        ahead[k] = out[0]
    clauses: list[list[tuple[int, int]]] = []
    clause: list[tuple[int, int]] = []
    state = 0
    for k, kind in enumerate(kinds):
        state, (found, target, negated, told) = _FORWARD[state, kind]
        if found:
            context = 3 if told else 2 if negated else 1 if target or ahead[k] else 0
            term = terms[tokens[k]]
            clause.append((term, context + (8 if term >= len(TERMS) else 4 if found == THREAT else 0)))
        elif kind in (CLAUSE, SENTENCE) and clause:
            clauses.append(clause)
            clause = []
    return clauses + [clause] if clause else clauses


def terms_of(text: str) -> set[str]:
    """The words of a text and, with a star, their beginnings; words with a class of their own only as themselves."""
    words = {t for t in _TOKEN.findall(text.lower()) if t not in _CLASS or t in _CORE}
    return words.union(*[{t[:n] + "*" for t in words if n < len(t) and t not in _CORE} for n in BEGINNINGS])


def term_counts(training: DataFrame) -> DataFrame:
    """``term, bad, good``: toxic and other rows of ``training(text, toxic)`` with each term; the null term counts all rows.

    A task adds up what it meets, so a common term is one row for each ``COUNTED`` terms.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, list[int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            items = iter(counts.items())
            while part := list(islice(items, 20_000)):
                columns = [pa.array([t for t, _ in part], pa.string())] + [pa.array([c[k] for _, c in part], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "bad", "good"])
            counts.clear()

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                side = 0 if toxic.as_py() else 1
                for term in (None, *terms_of(text.as_py() or "")):
                    counts.setdefault(term, [0, 0])[side] += 1
                if len(counts) >= COUNTED:
                    yield from flush()
        yield from flush()

    rows = training.select("text", "toxic").mapInArrow(work, "term string, bad long, good long")
    return rows.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learn(training: DataFrame) -> Lexicon:
    """The lexicon of ``training(text, toxic)``; a bounded table is collected."""
    listed = F.coalesce(F.col("term").isin(*TERMS), F.lit(False))
    tested = scratch.store(term_counts(training).where((F.col("bad") >= LEAST_SUPPORT) | F.col("term").isNull() | listed), "terms")
    total = tested.where("term is null").first()
    bad, good = (total["bad"], total["good"]) if total else (0, 0)

    def odds(r) -> float:
        return math.log((r["bad"] + 0.5) / (bad + 1)) - math.log((r["good"] + 0.5) / (good + 1))

    seen = {r["term"]: r for r in tested.where(listed).collect()}
    weights = [float(np.clip(odds(seen[t]), 0.0, 8.0)) if t in seen else PRIOR for t in TERMS]
    if not bad or not good:
        return Lexicon((), tuple(weights))
    own, base = F.col("bad") / (F.col("bad") + F.col("good")), bad / (bad + good)
    evidence = F.col("bad") * F.log(own / base) + F.when(
        F.col("good") > 0, F.col("good") * F.log((1 - own) / (1 - base))
    ).otherwise(0.0)
    score = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    fresh = tested.where(F.col("term").isNotNull() & ~listed)
    least = math.log(max(1, fresh.count()) / FALSE_TERMS)
    proven = fresh.where((own > base) & (score >= LEAST_ODDS) & (evidence >= least))
    if proven.count() > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} learnt terms: raise LEAST_SUPPORT or LEAST_ODDS")
    found = sorted(proven.collect(), key=lambda r: r["term"])
    # a beginning with no more support than one of its words says nothing that the word does not
    words = {t: r["bad"] for t, r in seen.items()} | {r["term"]: r["bad"] for r in found if not r["term"].endswith("*")}
    single: dict[str, int] = {}
    for word, n in words.items():
        for k in BEGINNINGS:
            if k < len(word):
                single[word[:k] + "*"] = max(n, single.get(word[:k] + "*", 0))
    kept = [r for r in found if r["bad"] > single.get(r["term"], 0)]
    return Lexicon(tuple(r["term"] for r in kept), tuple(weights + [float(np.clip(odds(r), 0.0, 8.0)) for r in kept]))


def summed(clauses: list[list[tuple[int, int]]], weights: tuple[float, ...]) -> list[float]:
    """Per label, log(1 + summed weight of the clauses whose heaviest match has it)."""
    x = [0.0] * len(LABELS)
    for clause in clauses:
        weight, label = max((weights[t], n) for t, n in clause)
        x[label] += weight
    return [math.log1p(v) for v in x]


def features(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, x``: the summed clause weights of every row."""
    fields = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", fields.schema["id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [summed(matches(v.as_py() or "", lexicon), lexicon.weights) for v in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(made, pa.list_(pa.float64()))], names=["id", "x"])

    return fields.mapInArrow(work, schema)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Logistic regression with a small ridge by Newton steps; the last weight is the constant.

    Without both classes the constant gives the share of the one there is, smoothed.
    """
    wide = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(wide.shape[1])
    beta[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if len(set(y.tolist())) < 2:
        return beta
    penalty = np.full(wide.shape[1], ridge)
    penalty[-1] = 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(wide @ beta, -30, 30)))
        slope = wide.T @ (y - p) - penalty * beta
        curve = (wide * (p * (1 - p))[:, None]).T @ wide + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def score_texts(
    docs: DataFrame, labels: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Per row: ``id, held_out, score, predicted``. ``labels`` has the id and ``toxic``; ``held_out`` is a condition on ``id``."""
    known = labels.where("toxic in (0, 1)").select(id, F.col("toxic").cast("int").alias("toxic"))
    usable = docs.where(~F.coalesce(held_out, F.lit(False)))
    # texts meet their labels by shuffle at every size: the list of labels grows with the documents
    lexicon = learn(usable.select(F.col(id), F.col(text).alias("text")).join(known.hint("merge"), id))
    rows = scratch.store(features(docs, lexicon, id, text), "features")
    marked = rows.withColumnRenamed("id", id).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    training = scratch.store(
        marked.where(~F.col("held_out")).join(known.hint("merge"), id).select(F.col(id).alias("id"), "x", "toxic"), "training"
    )
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * training.count() < fit_rows
    got = training.where(share).select("x", "toxic").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(LABELS))
    y = got["toxic"].to_numpy(float)
    order = np.lexsort((y, *x.T))  # sums in one order, so that reruns agree
    beta = fit(x[order], y[order])
    total = F.lit(float(beta[-1]))
    for n in range(len(LABELS)):
        total = total + F.get("x", F.lit(n)) * float(beta[n])
    scored = marked.withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.select(id, "held_out", "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
