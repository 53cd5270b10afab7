"""Benchmark passages against a version that compares every window."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from strideframe.llm import decontamination as D


def _rows(df):
    return sorted(tuple(r) for r in df.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))).collect())


@pytest.mark.parametrize("size", [1, 2, 5, 10])
def test_against_plain_version(frame, size):
    rng = random.Random(size)
    letters = ["a", "B", "cé", "d1", "É", "zz"]
    text = lambda n: rng.choice(["", "-", "\n"]) + rng.choice([" ", "  ", ", "]).join(rng.choice(letters) for _ in range(n))
    items = [(k, text(rng.randrange(0, 14))) for k in range(12)]
    docs = [(k, text(rng.randrange(0, 60)) + rng.choice(["", "!"]) + (items[rng.randrange(12)][1] if rng.random() < 0.5 else "")) for k in range(60)]
    got = D.contamination(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), size)
    want = brute.contamination(docs, items, size)
    assert _rows(got) == sorted(want)
    assert any(r[2] for r in want)


def test_edges(frame, spark):
    passage = " ".join(f"w{k}" for k in range(14))
    items = [(2, passage), (10, passage.upper()), (None, "lonely words"), (3, None), (4, ""), (5, " ,.;"), (2, "other text"), (6, "İx 9")]
    docs = [(1, f"before {passage} after"), (1, f"before {passage} after"), (1, "unlike"), (None, passage), (2, None), (3, ""), (4, "so LONELY, Words!"),
            (5, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (6, "other text other-text"), (7, ("x " * 20_000) + passage + (" y" * 20_000)), (8, "İX 9"),
            (9, "w0 " * 500)]
    table = frame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n_hit int, key string")
    found = D.contamination(table, frame([(i, t, 1) for i, t in items], "item_id long, text string, print int"))
    want = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in brute.contamination(docs, items, 10))
    assert _rows(found) == want
    assert D.contamination(table.limit(0), frame(items, "item_id long, text string")).count() == 0
    none = D.contamination(frame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == len(docs)


def test_every_long_shared_span_has_a_kept_fingerprint(spark):
    rng = random.Random(4)
    rows = [(k, [str(rng.randrange(3)) for _ in range(rng.randrange(10, 60))]) for k in range(50)]
    df = spark.createDataFrame(rows, "id long, words array<string>").select("id", "words", D.kept(F.col("words"), 10).alias("runs"))
    for r in df.collect():
        starts = [s for run in r["runs"] for s in range(run["start"], run["start"] + len(run["span"].split()) - 9)]
        assert starts == list(range(len(r["words"]) - 9))
        assert all(run["span"].split() == r["words"][run["start"] : run["start"] + len(run["span"].split())] for run in r["runs"])


def test_plan_has_no_python(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    plan = D.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
