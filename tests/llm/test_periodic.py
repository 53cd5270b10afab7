"""Periodic runs against a version that tries every period."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest

from strideframe.llm import periodic as P
from strideframe.llm.queries import QUERIES


def _words(rng):
    n, letters = rng.randrange(0, 150), rng.choice([1, 2, 2, 3, 6])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n:
            start, period = rng.randrange(n), rng.randrange(1, 25)
            for i in range(start + period, min(n, start + period * rng.randrange(1, 8))):
                words[i] = words[i - period]
    return words


@pytest.mark.parametrize("piece", [1, 7, 1000])
@pytest.mark.parametrize("exponent,length", [(2, 0), (3, 0), (4, 6)])
def test_runs_against_plain_version(exponent, length, piece):
    rng = random.Random(piece * 10 + exponent)
    for _ in range(60 if piece > 1 else 15):
        words, catchers, at = _words(rng), P.Catchers(exponent, length), 0
        while at < len(words):
            size = rng.randrange(1, piece + 1)
            catchers.append(np.array(words[at : at + size], np.uint64))
            at += size
        assert [tuple(r) for r in catchers.runs().tolist()] == brute.runs(words, exponent, length), words


def test_runs_are_known_while_words_arrive():
    words, catchers = [1, 2] * 12 + [3, 4, 5], P.Catchers(2, 0)
    for n, word in enumerate(words, 1):
        catchers.append(np.array([word], np.uint64))
        assert [tuple(r) for r in catchers.runs().tolist()] == brute.runs(words[:n], 2, 0)


def test_long_run_and_long_text():
    for period in (1, 9, 4000):
        catchers = P.Catchers(4, 6)
        catchers.append((np.arange(300_000) % period).astype(np.uint64))
        assert catchers.runs().tolist() == [[0, 300_000, period]]


def test_words_of_equal_hash_are_told_apart():
    words = [b"a", b"b"] * 4 + [b"c"]
    wrong = np.array([[0, 9, 1]])
    assert P._confirmed(words, wrong, 4, 6).tolist() == [[0, 8, 2]]


def test_edges(frame, spark):
    text = "a b " * 5 + "end"
    rows = [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, " \t\n"), (5, "é " * 40_000), (6, "x"), (7, "a a a a a"), (8, "b b b b b b")]
    docs = frame([(i, t, 0, "r") for i, t in rows], "doc_id long, text string, n_words int, runs string")
    got = sorted(
        (r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.collapse_runs(docs).collect()
    )
    want = []
    for i, t in rows:
        words = brute.WORD.findall(t or "")
        found = [(0, 40_000, 1)] if i == 5 else brute.runs(words, 4, 6)
        want.append((i or 0, len(words), [(s, e - s, q) for s, e, q in found], brute.without_runs(words, found)))
    assert got == sorted(want)
    assert P.collapse_runs(spark.createDataFrame([], docs.schema)).count() == 0


def test_query_against_plain_version(spark, sf_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(texts)
    with_runs = 0
    for doc in texts:
        words = brute.WORD.findall(doc["text"] or "")
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = brute.runs(words, 4, 6) if n < 3000 else None
        if found is None:
            continue
        r = rows[doc["doc_id"]]
        top = max(found, key=lambda x: (x[1] - x[0], -x[0], -x[2]), default=None)
        with_runs += bool(found)
        assert r["n_runs"] == len(found)
        assert (r["start"], r["length"], r["period"]) == ((top[0], top[1] - top[0], top[2]) if top else (None,) * 3)
        assert r["exponent_milli"] == (1000 * (top[1] - top[0]) // top[2] if top else None)
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute.without_runs(words, found).encode()).hexdigest()
    assert with_runs > 5
