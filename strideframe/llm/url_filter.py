"""Judge addresses by rules and by a weighted vocabulary of strict and soft terms.

An Aho-Corasick automaton finds all terms of the vocabulary in one pass over the lower-cased address. A hit counts only
between boundaries (neither neighbour is an ASCII letter or digit). One strict term blocks; soft terms block when at least
``LEAST_SOFT`` different ones hit and their weights reach ``LEAST_WEIGHT``. A rule (host, path) that fits decides alone:
a rule fits its host and all subdomains when the path starts with the rule's, and the longest rule wins.

Nulls and repeats: a null address or one without ``://`` has an empty host and path; null addresses are allowed by the
method. Equal addresses are judged alike. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the vocabulary
STRICT = (
    "porn", "porno", "xxx", "hentai", "escort", "escorts", "camgirl", "camgirls", "warez", "keygen", "phishing",
    "malware", "ransomware", "darknet", "bestiality",
)
SOFT = {
    "sex": 1.0, "sexy": 1.0, "adult": 0.8, "nude": 1.0, "casino": 1.0, "poker": 0.8, "bet": 0.6, "betting": 1.0, "bonus": 0.5,
    "viagra": 1.0, "cialis": 1.0, "pills": 0.8, "crack": 0.8, "torrent": 0.8, "hack": 0.6, "cheat": 0.6, "free": 0.4,
    "win": 0.4, "loan": 0.6, "loans": 0.6, "payday": 0.8, "replica": 0.8, "dating": 0.7, "hot": 0.4,
}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
LEAST_SOFT, LEAST_WEIGHT = 2, 1.2
#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host + path`` and its verdict; both null when none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r)):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        name = F.when(fits, F.lit(own + start)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def automaton(strict: Iterable[str] = STRICT, soft: dict[str, float] = SOFT) -> ahocorasick.Automaton:
    """Term -> (term, weight); a strict term has no weight."""
    machine = ahocorasick.Automaton()
    for term, weight in soft.items():
        machine.add_word(term, (term, weight))
    for term in strict:
        machine.add_word(term, (term, None))
    machine.make_automaton()
    return machine


def hits(machine: ahocorasick.Automaton, url: str) -> tuple[set[str], dict[str, float]]:
    """Different strict and soft terms that stand between boundaries."""
    strict: set[str] = set()
    soft: dict[str, float] = {}
    text = url.lower()
    for last, (term, weight) in machine.iter(text):
        first = last - len(term) + 1
        if (first and text[first - 1] in _WORD) or text[last + 1 : last + 2] in _WORD:
            continue
        if weight is None:
            strict.add(term)
        else:
            soft[term] = weight
    return strict, soft


def vocabulary_verdict(
    pages: DataFrame,
    url: str = "url",
    strict: Iterable[str] = STRICT,
    soft: dict[str, float] = SOFT,
    least_soft: int = LEAST_SOFT,
    least_weight: float = LEAST_WEIGHT,
) -> DataFrame:
    """``pages`` with ``strict_hits``, ``soft_hits`` (different terms), ``soft_weight`` and ``word_verdict``."""
    strict, soft = tuple(strict), dict(soft)
    added = [
        T.StructField("strict_hits", T.LongType()), T.StructField("soft_hits", T.LongType()),
        T.StructField("soft_weight", T.DoubleType()), T.StructField("word_verdict", T.StringType()),
    ]
    names = [f.name for f in added]
    kept = [f for f in pages.schema.fields if f.name not in names]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(strict, soft)
        for batch in batches:
            made = []
            for value in batch.column(url):
                hard, mild = hits(machine, value.as_py() or "")
                weight = float(sum(mild[t] for t in sorted(mild)))
                block = bool(hard) or (len(mild) >= least_soft and weight >= least_weight)
                made.append((len(hard), len(mild), weight, "block" if block else "allow"))
            columns = list(zip(*made)) if made else [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_pydict(
                {f.name: batch.column(f.name) for f in kept} | {n: pa.array(c, t) for n, c, t in zip(names, columns, types)}
            )

    return pages.mapInArrow(work, T.StructType(kept + added))


def judge(pages: DataFrame, url: str = "url", rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and the vocabulary's counts."""
    scored = vocabulary_verdict(pages, url).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(verdict, F.col("word_verdict"))})
