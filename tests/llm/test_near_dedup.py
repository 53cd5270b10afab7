import random

import brute
import pytest

from strideframe.llm import near_dedup as N

SCHEMA = "doc_id long, text string"


def _prose(n, seed, words=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def _result(docs, **more):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs, **more).collect()}


def test_groups_match_brute_force(frame):
    """Chains of edited copies, copies of equal sets, texts near the threshold from both sides, and strangers."""
    rng = random.Random(5)
    rows = []
    for group in range(6):
        text = _prose(rng.choice([12, 40, 150]), group)
        for copy in range(9):
            rows.append((len(rows), " ".join(text)))
            for _ in range(rng.choice([0, 1, 1, 2])):
                text = list(text)
                text[rng.randrange(len(text))] = f"x{rng.random()}"
    rows += [(len(rows) + k, " ".join(_prose(60, 100 + k))) for k in range(20)]
    want = brute.components(rows)
    got = _result(frame(rows, SCHEMA))
    assert {i: c for i, (_, c, _) in got.items()} == want
    assert all(got[i][0] == len(brute.shingles(t)) and got[i][2] == (want[i] == i) for i, t in rows)
    assert 1 < len(set(want.values())) < len(rows)


def test_blocks_link_what_pivots_leave(frame, monkeypatch):
    """Without pivot rounds and with tiny blocks every link comes from the block comparison."""
    monkeypatch.setattr(N, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(N, "BLOCK_ROWS", 3)
    base = _prose(80, 1)
    rows = []
    for k in range(14):
        text = list(base)
        text[k * 5] = f"y{k}"
        rows.append((k, " ".join(text)))
    want = brute.components(rows)
    assert {i: c for i, (_, c, _) in _result(frame(rows, SCHEMA)).items()} == want


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO\n"), (6, "one two three"), (7, "a b c d e"),
            (8, "a b c d e"), (8, "a b c d e"), (None, "a b c d e"), (9, "İstanbul a b c d"), (10, "i̇stanbul a b c d")]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(frame(rows, SCHEMA)).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0)) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 7, True),
        (8, 1, 7, False), (8, 1, 7, False), (9, 1, 9, True), (10, 1, 10, True), (None, 1, None, True),
    ]


def test_empty_table_and_foreign_columns(frame, spark):
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = frame([(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2)], "doc_id long, text string, bands string, component_id int")
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1]


def test_long_text(frame):
    text = " ".join(_prose(60_000, 3, 50_000))
    got = _result(frame([(1, text), (2, text + " end"), (3, "x" * 200_000)], SCHEMA))
    assert got[2][1] == 1 and got[3] == (1, 3, True)


@pytest.mark.parametrize("percent", [70, 85, 95])
def test_bayes_bounds(percent):
    steps = N.least_matches(percent, 1e-6)
    assert [n for n, _ in steps] == [24, 48, 72, 96, 120]
    assert all(0 <= m <= n * percent / 100 for n, m in steps)


def test_keep_one_takes_pairs_from_80_percent(frame):
    """Pairs of every similarity from 0.70 to 0.95: it keeps what brute force at 80 keeps."""
    rows = []
    for pair in range(26):
        text = _prose(200, 300 + pair, 5000)
        rows.append((2 * pair, " ".join(text)))
        cut = 5 + pair * 2
        rows.append((2 * pair + 1, " ".join(text[:-cut] + [f"z{pair}_{k}" for k in range(cut // 4)])))
    want = brute.components(rows, percent=80)
    assert want != brute.components(rows, percent=85)
    got = sorted(r["doc_id"] for r in N.keep_one(frame(rows, SCHEMA), percent=80).collect())
    assert got == sorted(set(want.values()))


@pytest.mark.parametrize("percent", [60, 80, 85, 100])
def test_bands_follow_the_threshold(percent):
    assert (1 - (percent / 100) ** N.ROWS) ** N.bands_for(percent) <= 1e-6
    assert N.bands_for(85) == N.BANDS == 24


def test_rows_that_share_an_id_share_their_links(frame):
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, "alone here")]
    got = {(r["doc_id"], r["component_id"]) for r in N.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (9, 9)}
    assert [r["doc_id"] for r in N.keep_one(frame(rows, "doc_id long, text string")).orderBy("doc_id").collect()] == [1, 9]
    apart = [(5, a, "x"), (5, b, "y"), (5, a.upper(), "z"), (6, b + " more", "w"), (5, None, "n")]
    kept = N.keep_one(frame(apart, "doc_id long, text string, content string"))
    assert sorted((r["doc_id"], r["content"]) for r in kept.collect()) == [(5, "n"), (5, "y"), (5, "z")]
    assert kept.columns == ["doc_id", "text", "content"]
