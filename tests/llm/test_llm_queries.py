"""The operator queries against their SQL, and the pipeline against plain versions."""

import hashlib

import brute
import oracle
import pytest

import corpus_pipeline as C
from strideframe.llm.queries import ORACLES, QUERIES

KINDS = {"int": "INTEGER"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    df = df.select(*[df[n].cast("long" if kind == "int" else kind).alias(n) for n, kind in df.dtypes])
    sql = ORACLES[name]
    if name.startswith("op5_"):
        sql = f"select query_id, rank::bigint as rank, vec_id, score from ({sql})"
    assert oracle.compare(duck, sql, df) is None


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = C.scratch.store(docs, "test-stage")
        kept[name] = docs
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
    rows = {n: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()] for n, df in kept.items() if n != "byte_bpe"}
    judged = {r["doc_id"] for r in QUERIES["op9_quality_rules"](spark, sf_dir).where("kept").collect()}
    assert {i for i, _ in rows["quality_rules"]} == judged
    groups = brute.components(rows["quality_rules"], percent=80)
    assert sorted(i for i, _ in rows["near_dedup"]) == sorted(set(groups.values()))
    assert [i for i, _ in sorted(rows["secrets"])] == [i for i, _ in sorted(rows["near_dedup"])]
    assert all(not brute.base_spans(t) for _, t in rows["secrets"])
    before = dict(rows["near_dedup"])
    assert all(t == before[i] for i, t in rows["secrets"] if not brute.base_spans(before[i]) and "eyJ" not in t and "BEGIN" not in t)
    secret_free = dict(rows["secrets"])
    mixed = sorted(rows["mixing"])
    assert all(secret_free[i] == t for i, t in mixed) and len(mixed) > len(set(mixed))
    last = kept["byte_bpe"].collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in last) == [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in mixed]
    assert all(r["n_tokens"] == len(r["ids"]) for r in last)
    assert C.run(spark, sf_dir).count() == len(mixed)
