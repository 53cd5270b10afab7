import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.llm import archive, components, mixing, quality, search, toxicity, url_filter
from strideframe.llm.queries import QUERIES

# --- archive


def test_archive_round_trip(frame, tmp_path, spark):
    rows = [(1, "http://a", "x"), (2, "http://b\r\nX: y", "x"), (3, None, None), (4, "http://c", ""), (5, "http://d", "é" * 70_000),
            (None, "http://e", "x"), (None, "http://f", "only"), (1, "http://a", "x"), (6, "u", "line\r\n\r\nWARC/1.1\r\n")]
    pages = frame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/a"
    archive.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 5
    got = archive.read_archive(spark, folder).select(
        "id", "payload", archive.header_field(F.col("header"), "WARC-Type").alias("kind"),
        archive.header_field(F.col("header"), "WARC-Refers-To").alias("refers"),
        archive.header_field(F.col("header"), "WARC-Payload-Digest").alias("sha1"),
    ).collect()
    bodies = sorted(bytes(r["payload"]).decode() for r in got)
    assert bodies == sorted(r[2] or "" for r in rows)
    for r in got:
        assert r["sha1"] == "sha1:" + base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
        first = {"x": 1, "": 3}.get(bytes(r["payload"]).decode())
        revisit = first is not None and r["id"] != first
        assert r["kind"] == ("revisit" if revisit else "response")
        assert r["refers"] == (f"<urn:page:{first}>" if revisit else None)


def test_archive_least_size_files_and_damage(frame, tmp_path, spark):
    pages = frame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/b"
    archive.write_archive(pages, folder, least=4)
    records = archive.read_archive(spark, folder)
    kinds = {r["id"]: r["k"] for r in records.select("id", archive.header_field(F.col("header"), "WARC-Type").alias("k")).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    archive.export_warc(records, f"file://{tmp_path}/warc")
    lines = spark.read.text(f"file://{tmp_path}/warc").where("value = 'WARC/1.1'")
    assert lines.count() == 4
    spark.read.parquet(f"{folder}/payloads").limit(1).write.parquet(f"file://{tmp_path}/c/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"file://{tmp_path}/c/records")
    with pytest.raises(Exception, match="no payload is stored"):
        archive.read_archive(spark, f"file://{tmp_path}/c").count()


def test_archive_forged_fields(frame, tmp_path, spark):
    rows = [(7, "http://a", "x"), (8, "http://b\u2028WARC-Refers-To: <urn:page:7>", "y"), (9, "http://c\x85WARC-Type: revisit\r\nWARC-Type: revisit", "z")]
    folder = f"file://{tmp_path}/forged"
    archive.write_archive(frame(rows, "page_id long, url string, html string"), folder)
    got = archive.read_archive(spark, folder)
    field = lambda name: archive.header_field(F.col("header"), name)
    found = {r["id"]: r for r in got.select("id", field("WARC-Refers-To").alias("refers"), field("WARC-Type").alias("kind"), field("WARC-Target-URI").alias("url")).collect()}
    assert all(r["refers"] is None and r["kind"] == "response" for r in found.values())
    assert found[8]["url"] == "http://b%E2%80%A8WARC-Refers-To: <urn:page:7>"
    assert found[9]["url"] == "http://c%C2%85WARC-Type: revisit%0D%0AWARC-Type: revisit"


def test_archive_empty(spark, tmp_path):
    archive.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/e")
    assert archive.read_archive(spark, f"file://{tmp_path}/e").count() == 0


# --- mixing


def _fill(sizes, weights, share=1.5, most=2):
    """Share the total by weight; what passes a limit is shared again among the others."""
    total, target = share * sum(sizes), [0.0] * len(sizes)
    full = set()
    while True:
        rest = total - sum(most * sizes[k] for k in full)
        open_ = [k for k in range(len(sizes)) if k not in full]
        if not open_:
            return [most * s for s in sizes]
        for k in open_:
            target[k] = rest * weights[k] / sum(weights[j] for j in open_)
        over = {k for k in open_ if target[k] > most * sizes[k]}
        if not over:
            return [most * sizes[k] if k in full else target[k] for k in range(len(sizes))]
        full |= over


def test_mixing_targets_and_copies(frame):
    rng = random.Random(3)
    rows, names = [], ["b", "a", "é", "Z", None, ""]
    for i in range(3000):
        source = names[min(len(names) - 1, int(rng.expovariate(0.9)))]
        rows.append((i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(30))), source, i))
    docs = frame(rows, "doc_id long, text string, source string, mix_size int")
    got = mixing.mix(docs).collect()
    order = sorted((n for n in names if n is not None), key=lambda s: s.encode()) + [None]
    sizes = [sum(len(t.split()) for _, t, s, _ in rows if s == name) for name in order]
    want = dict(zip(order, _fill(sizes, [(3, 1, 2)[k % 3] for k in range(len(order))])))
    assert len(got) == len(rows)
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert math.isclose(r["mix_target"], want[r["source"]], rel_tol=1e-12) and 0 <= r["mix_copies"] <= 2
        assert r["mix_size"] == len(r["text"].split())
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
    for name, own in zip(order, sizes):
        assert abs(taken[name] - want[name]) <= 5 * 30 * math.sqrt(sum(1 for r in rows if r[2] == name)) / 2
    again = {r["doc_id"]: r["mix_copies"] for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["mix_copies"] for r in got}
    emitted = mixing.emit(mixing.mix(docs))
    assert emitted.count() == sum(r["mix_copies"] for r in got) and emitted.columns == ["doc_id", "text", "source"]


def test_mixing_edges(frame, spark, monkeypatch):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = mixing.mix(frame([(1, None, "a"), (None, "x y", None), (None, "x y", None), (2, "", "b")], schema)).collect()
    assert {(r["source"], r["mix_source_size"]) for r in rows} == {("a", 0), ("b", 0), (None, 4)}
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # the shuffled join gives the same
    other = mixing.mix(frame([(1, None, "a"), (None, "x y", None), (None, "x y", None), (2, "", "b")], schema)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, other))


# --- search


@pytest.mark.parametrize("block, shard", [(1024, 8192), (3, 5)])
def test_top_k_against_full_products(frame, monkeypatch, block, shard):
    monkeypatch.setattr(search, "QUERY_BLOCK", block)
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "FAN_IN", 2)
    rng = random.Random(7)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(4)]) for i in range(90)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, [0.5] * 4)]
    rows += [(220, [1.0, 1.0]), (221, [0.5, -1.0]), (5, rows[5][1]), (240, [])]
    got = {}
    for r in search.top_k(frame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    clean = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q, own in clean.items():
        if q % 20 == 0:
            others = [(-sum(a * b for a, b in zip(own, v)), i) for i, v in clean.items() if i != q and len(v) == len(own)]
            want = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(others)[:6])]
            assert sorted(got.get(q, [])) == want


def test_top_k_large_components_and_empty(frame, spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, -5.0]), (2, [-1e30, 0.0]), (3, [1e30, 7.0])]
    got = search.top_k(frame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [3, 1, 2]
    assert {r["score"] for r in got} == {2**63 - 1, -(2**63)}
    assert search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_products_beyond_doubles_and_repeated_rows(frame):
    rows = [(0, [1e308, 1.0]), (1, [1e308, -5.0]), (2, [-1e308, 0.5]), (2, [-1e308, 0.5]), (3, [0.25, 7.0]), (3, [0.25, 7.0])]
    got = search.top_k(frame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=9).collect()
    whole = lambda v: [int(x) * 64 if abs(x) > 1e300 else math.floor(64 * x) for x in v]
    score = lambda v: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole(rows[0][1]), whole(v)))))
    want = sorted(((i, score(v)) for i, v in rows[1:]), key=lambda x: (-x[1], x[0]))
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == want


# --- toxicity


def test_grammar_contexts():
    label = lambda text: [toxicity.LABELS[n] for clause in toxicity.matches(text) for _, n in clause]
    assert label("what a moron") == ["insult_bare"]
    assert label("You are such an idiot, really") == ["insult_target"]
    assert label("idiot that you are") == ["insult_target"]
    assert label("he is not stupid") == ["insult_negated"]
    assert label("She said the clown left. A clown") == ["insult_reported", "insult_bare"]
    assert label("I will kill you") == ["threat_target"]
    assert label("clean text, no terms") == [] and label("") == []


def _plain_matches(text, lexicon):
    """Contexts looked up token by token from their definition, without machines."""
    T = toxicity
    tokens = re.findall(r"[^\W_]+(?:'[^\W\d_]+)?|[.!?;,:\n]", text.lower())

    def term(token):
        if token in T.TERMS:
            return T.TERMS.index(token)
        if token in T.TARGETS + T.NEGATIONS + T.REPORTS or not token[0].isalnum():
            return None
        names = [token] + [token[:n] + "*" for n in range(len(token) - 1, 0, -1)]
        return next((lexicon.learnt[n] for n in names if n in lexicon.learnt), None)

    out, clause = [], []
    for k, token in enumerate(tokens):
        if token in ".!?\n;,:":
            out, clause = out + [clause] * bool(clause), []
        elif (number := term(token)) is not None:
            ends = [j for j, t in enumerate(tokens) if t in ".!?\n;,:"]
            low, high = max([j + 1 for j in ends if j < k], default=0), min([j for j in ends if j > k], default=len(tokens))
            sentence = max([j + 1 for j, t in enumerate(tokens[:k]) if t in ".!?\n"], default=0)
            told = any(t in T.REPORTS for t in tokens[sentence:k])
            negated = any(t in T.NEGATIONS for t in tokens[max(low, k - T.NEGATION_SCOPE) : k])
            target = any(t in T.TARGETS for t in tokens[max(low, k - T.TARGET_SCOPE) : k] + tokens[k + 1 : min(high, k + 1 + T.TARGET_SCOPE)])
            kind = 8 if number >= len(T.TERMS) else 4 if token in T.THREATS else 0
            clause.append((number, kind + (3 if told else 2 if negated else 1 if target else 0)))
    return out + [clause] * bool(clause)


def test_grammar_against_plain_version():
    rng = random.Random(6)
    lexicon = toxicity.Lexicon(("fleeb", "grax*", "gra*"))
    words = ["you", "he", "not", "never", "said", "moron", "idiot", "kill", "fleeb", "graxon", "gravel", "graz", "table", "tree", "x1", ",", ";", ".", "!", "\n"]
    some = 0
    for _ in range(3000):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(30)))
        want = _plain_matches(text, lexicon)
        some += bool(want)
        assert toxicity.matches(text, lexicon) == want, text
    assert some > 1000
    label = lambda text: [toxicity.LABELS[n] for clause in toxicity.matches(text, lexicon) for _, n in clause]
    assert label("you are a fleeb") == ["learnt_target"] and label("he said you are not a fleeb") == ["learnt_reported"]


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op6_toxicity"](spark, folder).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"], r["doc_id"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    found = [y for y, p, _ in judged if p]
    assert found and sum(found) / len(found) > 0.95  # precision
    with_terms = [p for y, p, i in judged if y and toxicity.matches(texts[i])]
    assert sum(with_terms) / len(with_terms) > 0.9  # recall of toxic texts that hold any term


def test_toxicity_learns_words_of_other_languages(spark):
    """Toxic texts without a listed term are found by words and beginnings that training texts share."""
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, folder).where("held_out")
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).collect()
    for lang in ("de", "en", "es", "fr"):
        toxic = [r["predicted"] for r in rows if r["lang"] == lang and r["toxic"]]
        assert sum(toxic) / len(toxic) > 0.6, lang
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert sum(toxic) / len(toxic) > 0.85  # recall over all held-out toxic labels
    found = [r["toxic"] for r in rows if r["predicted"]]
    assert sum(found) / len(found) > 0.95


def test_toxicity_edges(frame, spark):
    docs = frame([(1, None, 3), (2, "", 4), (None, "you moron", 5), (4, "you moron", 6), (4, "you moron", 6)], "doc_id long, text string, score int")
    held = F.col("doc_id") == 2
    for labels in ([], [(1, 1, None)], [(1, 1, 0), (4, 1, 1), (4, 1, 1), (9, 1, 1)]):
        got = toxicity.score_texts(docs, frame(labels, "doc_id long, quality int, toxic int"), held).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert toxicity.score_texts(spark.createDataFrame([], docs.schema), frame([], "doc_id long, toxic int"), held).count() == 0


# --- URL filter


def test_url_rules_and_terms(frame, spark):
    rows = [
        (1, "HTTP://Blog.Example.NET/en/x", "blog.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://a.net", "a.net", "", None, "allow"),
        (3, "https://a.net/", "a.net", "/", "net/", "block"),
        (4, "https://notexample.com/de/1?x://y", "notexample.com", "/de/1", None, "allow"),
        (5, "https://example.com/de/1#t", "example.com", "/de/1", "example.com/de/", "block"),
        (6, None, "", "", None, "allow"),
        (7, "no scheme/xxx/", "", "", None, "block"),
        (8, "http://x.io/casino-free-poker?a", "x.io", "/casino-free-poker", None, "block"),
        (9, "http://x.io/casino/casino", "x.io", "/casino/casino", None, "allow"),
        (10, "http://essex.io/xxxl", "essex.io", "/xxxl", None, "allow"),
        (11, "http://org/fr/porn", "org", "/fr/porn", "org/fr/", "allow"),
        (None, "http://u@h:80/a\nb", "u@h:80", "/a\nb", None, "allow"),
    ]
    pages = frame([(r[0], r[1], "r") for r in rows], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got == {r[0]: r[2:] for r in rows}
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


# --- quality


def test_binomial_cdf(spark):
    def plain(x, n, p):
        return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1))

    cases = [(x, n) for n in (1, 7, 60, 400) for x in (0, 1, 3, n // 2, n) if x <= n]
    rows = spark.createDataFrame(cases, "x int, n int").select("x", "n", quality.binomial_cdf(F.col("x"), F.col("n"), 0.03).alias("p"))
    for r in rows.collect():
        assert math.isclose(r["p"], plain(r["x"], r["n"], 0.03), rel_tol=1e-9)
    big = spark.createDataFrame([(60, 20_000)], "x int, n int").select(quality.binomial_cdf(F.col("x"), F.col("n"), 0.01).alias("p"))
    assert 0 < big.first()["p"] < 1e-20


def test_cutoffs_keep_the_promise(frame):
    """A measure that good documents often exceed gets no cutoff there; one they never exceed gets the strictest."""
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        for stratum in ("a", "b"):
            rows.append((stratum, i * 2 + (stratum == "b"), 0.35 if stratum == "a" and rng.random() < 0.05 else 0.0, 0.0, 0.0, 5.0))
    good = frame(rows, "stratum string, draw long, symbol_ratio double, dup_line_ratio double, repeat_ratio double, mean_word_chars double")
    got = {r["stratum"]: r for r in quality.cutoffs(good, 2).collect()}
    assert got["a"]["symbol_ratio_cutoff"] == 0.5 and got["b"]["symbol_ratio_cutoff"] == 0.05
    few = {r["stratum"] for r in quality.cutoffs(good.where("draw < 100"), 2).collect()}
    assert few == set()  # 50 labels prove nothing


def test_rejections_of_all_measures_together_stay_below_alpha(spark):
    """Measures that each hit a different 0.8 % of the good documents would together reject 3.2 %."""
    u = F.pmod(F.xxhash64("id"), F.lit(1000))
    names = list(quality.MEASURES)
    hit = lambda k: F.when((u >= 8 * k) & (u < 8 * k + 8), 100.0).otherwise(0.0).alias(names[k])
    good = spark.range(200_000).select(F.lit("s").alias("stratum"), *[hit(k) for k in range(4)]).cache()
    limits = quality.cutoffs(good, 1).first()
    rejected = F.lit(False)
    for name in names:
        if limits is not None and limits[f"{name}_cutoff"] is not None:
            rejected = rejected | (F.col(name) > limits[f"{name}_cutoff"])
    assert good.where(rejected).count() <= 0.01 * 200_000
    assert limits is not None  # the first measure alone is accepted
    good.unpersist()


def test_copies_of_a_text_are_one_trial(frame):
    text = " ".join(f"w{i}" for i in range(20))
    docs = frame([(i, text, "en") for i in range(2000)] + [(5000, "#" * 60 + " " + text, "en")], "doc_id long, text string, lang string")
    labels = frame([(i, 1, 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    assert quality.judge(docs, labels).where("kept").count() == 2001  # one text proves nothing


def test_cutoffs_use_all_labels_of_a_small_stratum(spark):
    """800 labels of a stratum prove a cutoff, however many labels the others have."""
    zero = [F.lit(0.0).alias(n) for n in ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "mean_word_chars")]
    stratum = F.when(F.col("id") < 800, "small").otherwise("large").alias("stratum")
    good = spark.range(400_000).select(stratum, F.xxhash64("id").alias("draw"), *zero)
    got = {r["stratum"]: r["symbol_ratio_cutoff"] for r in quality.cutoffs(good, 4).collect()}
    assert got == {"small": 0.05, "large": 0.05}


def test_quality_edges(frame, spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    schema = "doc_id long, text string, lang string, q int, quality_kept string"
    docs = frame([(1, None, None, 1, "x"), (2, "", "en", 2, "y"), (None, long, None, 3, "z"), (4, "a b c d e a b c d e f", "en", 4, ""),
                  (5, "a\tb\n\n \nb\na\tb\n#$ %%", "en", 5, ""), (5, "a\tb\n\n \nb\na\tb\n#$ %%", "en", 5, "")], schema)
    labels = frame([(5, 1, 0), (5, None, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.judge(docs, labels).collect()}
    assert got[1] == got[2] == (0, 0, 0, 0, 0, True, False)
    assert got[None][0] == 30_000 and got[None][4:] == (0, False, True)
    assert got[4] == (11, 11, 0, 0, 10, True, False)
    assert got[5] == (7, 9, 4, 1, 0, True, False)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == ["doc_id", "text", "lang", "q"] and [r["doc_id"] for r in kept.collect()] == [None]
    assert quality.judge(spark.createDataFrame([], schema), labels).count() == 0


def test_keep_good_keeps_columns_named_like_its_own(frame):
    docs = frame([(1, " ".join(f"w{i}" for i in range(20)), "en", 0.5)], "doc_id long, text string, lang string, quality_score double")
    kept = quality.keep_good(docs, frame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert kept.columns == docs.columns and kept.first()["quality_score"] == 0.5


# --- components


def test_components_of_long_chains(frame, spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (7, 7), (None, 3), (50, 50)]
    got = {r["node"]: r["component"] for r in components.components(frame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {98: 98, 99: 98, 100: 98}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
