import random

import brute
import numpy as np

from strideframe.llm import span_dedup as D


def _got(docs, **more):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in D.remove_repeats(docs, **more).collect()}


def test_matches_brute_force(frame):
    """Shared passages, copies, periodic texts, windows at document ends; a tiny sketch flags nearly all and changes nothing."""
    rng = random.Random(9)
    passages = [[f"p{k}x{j}" for j in range(rng.randrange(15, 40))] for k in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(5)):
            words += [f"w{rng.randrange(30)}" for _ in range(rng.randrange(25))]
            words += rng.choice(passages)[rng.randrange(8) :]
        rows.append((i * 3 % 61, (" " if i % 2 else "\n\t").join(words)))
    rows += [(100, "a b c " * 20), (101, "z " * 45), (102, "a b c " * 20)]
    docs = frame(rows, "doc_id long, text string")
    want = brute.without_repeats(rows, 20)
    assert _got(docs) == want
    assert _got(docs, bits=16) == want
    small = brute.without_repeats(rows, 7)
    assert _got(docs, size=7) == small
    assert any(r for _, r, _ in want.values())


def test_chunks_of_a_task(frame, monkeypatch):
    rows = [(i, " ".join(f"c{(i * 7 + k) % 90}" for k in range(50))) for i in range(40)]
    monkeypatch.setattr(D, "CHUNK", 60)
    assert _got(frame(rows, "doc_id long, text string")) == brute.without_repeats(rows, 20)


def test_edge_rows(frame, spark):
    text = " ".join(f"t{k}" for k in range(25))
    schema = "doc_id long, text string, place string, run int"
    rows = [(5, text, "a", 1), (5, text, "b", 2), (7, text, "c", 3), (None, text, "d", 4), (8, None, "e", 5), (9, "", "f", 6)]
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in D.remove_repeats(frame(rows, schema)).collect())
    assert got == [("5", 25, 0), ("5", 25, 0), ("7", 25, 25), ("8", 0, 0), ("9", 0, 0), ("None", 25, 0)]
    assert D.remove_repeats(spark.createDataFrame([], schema)).count() == 0


def test_long_text(frame):
    rng = random.Random(1)
    words = [f"l{rng.randrange(10_000)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[30_000:])), (3, "y" * 300_000)]
    assert _got(frame(rows, "doc_id long, text string")) == brute.without_repeats(rows, 20)


def test_sketch_never_undercounts():
    words = np.array([1, 2, 3, 4] * 30, np.uint64)
    starts, places, hashes = D.anchors(words, np.array([0, 120]), 20)
    assert len(starts) == 101
    # equal windows have equal anchors at different places
    assert len({int(h) for h in hashes}) <= 4 and len(set(places.tolist())) > 4
