import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from strideframe.llm import byte_bpe as B
from strideframe.llm.arrow import text_buffers
from strideframe.llm.queries import QUERIES, VOCABULARY


@pytest.fixture(scope="module")
def library():
    lines = (line.split() for line in open(VOCABULARY, "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _ids(texts):
    words = B.vocabulary(B.read_vocabulary(VOCABULARY))
    ids, cuts = words.encode(*text_buffers(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]


def test_random_texts(library):
    rng = random.Random(2)
    signs = "ab'sstrevlmdLL \n\t\r\u00a0\u3000\u200b\u0085é9٣½!?.#’ʼAéx漢\U0001f600"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(4000)]
    assert _ids(texts) == [library.encode_ordinary(t) for t in texts]


def test_long_pieces_and_pieces_of_a_scan(library):
    rng = random.Random(3)
    texts = ["", None, "ab" * 3000, " " * 700, "!" * 900 + " x", "".join(rng.choice("etaoin") for _ in range(4000)), "it's 'll 'x"]
    assert _ids(texts) == [library.encode_ordinary(t or "") for t in texts]
    data, ends = text_buffers(pa.array(["it's  fine\n\n here we're 12 o'clock"] * 40))
    assert B.token_starts(data, ends, piece=7).tolist() == B.token_starts(data, ends).tolist()


def test_composition_table():
    rng = np.random.default_rng(1)
    for f, g in rng.integers(0, len(B._COMPOSED), (200, 2)):
        assert (B._FUNCTIONS[B._COMPOSED[f, g]] == B._FUNCTIONS[g][B._FUNCTIONS[f]]).all()


def test_query_round_trip(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_edge_rows(frame, spark):
    content = B.read_vocabulary(VOCABULARY)
    docs = frame([(1, None, 7), (2, "", 8), (None, "naïve x", 9), (None, "naïve x", 9)], "doc_id long, text string, ids int")
    rows = B.decode(B.encode(docs, content), content).collect()
    assert sorted((bytes(r["decoded"]), len(r["ids"])) for r in rows)[:2] == [(b"", 0), (b"", 0)]
    full = next(r for r in rows if r["text"] == "naïve x")
    pieces = B.vocabulary(content).pieces
    assert full["token_offsets"] == np.cumsum([0] + [len(pieces[i]) for i in full["ids"]])[:-1].tolist()
    assert B.decode(B.encode(spark.createDataFrame([], "doc_id long, text string"), content), content).count() == 0
