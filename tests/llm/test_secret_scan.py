import base64
import json
import random
import re
import time

import brute

from strideframe.llm import secret_scan as S
from strideframe.llm.queries import QUERIES


def _der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 | (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + body


RSA = _der(0x30, _der(2, b"\0") + b"".join(_der(2, bytes([0xAA + k]) * 40) for k in range(8)))
SSH = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", bytes(range(32))))


def _part(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


TOKEN = f"{_part({'alg': 'HS256'})}.{_part({'sub': 'x'})}.{base64.urlsafe_b64encode(bytes(32)).decode().rstrip('=')}"


def _kinds(text):
    return [S.KINDS[k] for _, k, _ in S.all_spans(text)]


def test_confirmed_kinds():
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{base64.encodebytes(RSA).decode()}-----END RSA PRIVATE KEY-----"
    assert _kinds(f"see {TOKEN} ok") == ["jwt"]
    assert _kinds(pem) == ["pem"]
    assert _kinds("ssh-ed25519 " + base64.b64encode(SSH).decode()) == ["key"]
    assert _kinds("x " + RSA.hex()) == ["hex", "key"]
    assert _kinds("x " + RSA.hex().upper()) == ["key"]


def test_url_safe_and_wrapped_keys():
    rng = random.Random(8)
    for n in range(300):
        key = _der(0x30, _der(2, b"\0") + _der(2, bytes(rng.randrange(256) for _ in range(113))))
        one = base64.urlsafe_b64encode(key).decode().rstrip("=" if n % 2 else "")
        assert S.confirmed_spans(f"see {one} ok") == [(4, 5, 4 + len(one))]
        plain = base64.b64encode(key).decode()
        for width, mark in ((64, ""), (40, ""), (64, "> "), (76, "  ")):
            for text in (plain, one):
                wrapped = "\n".join(mark + text[k : k + width] for k in range(0, len(text), width))
                span = (5 + len(mark), 5, 5 + len(wrapped))
                assert S.confirmed_spans(f"see:\n{wrapped}\nnext line") == [span]
                assert S.confirmed_spans(f"see:\n{wrapped}\nnext") == [span]
    standard = base64.b64encode(RSA).decode()
    assert S.confirmed_spans(f"my-{standard}") == [(3, 5, 3 + len(standard))]  # a part of one alphabet
    prose = "\n".join("abcdefghijklmnopqrstuvwxyz012345" for _ in range(50))
    assert S.confirmed_spans(prose) == []
    wrapped = "\n".join(standard[k : k + 64] for k in range(0, len(standard), 64))
    assert S.confirmed_spans(f"{'A' * 64}\n{wrapped}\n") == [(65, 5, 65 + len(wrapped))]
    assert S.confirmed_spans(("x" * 300_000 + "\n") * 2 + ("A" * 64 + "\n") * 20_000) == []  # linear time
    blob = base64.b64encode(SSH).decode()
    assert S.confirmed_spans(f"{blob[:40]}\n{blob[40:]}\nrest of text") == [(0, 5, len(blob) + 1)]


def test_unconfirmed_candidates_are_not_reported():
    rng = random.Random(1)
    noise = base64.b64encode(bytes(rng.randrange(256) for _ in range(300))).decode()
    assert _kinds(noise) == []
    assert _kinds(base64.b64encode(RSA[:-3]).decode()) == []  # a length points past the end
    assert _kinds(f"{_part({'typ': 'JWT'})}.{_part({})}.AAAA") == []
    assert _kinds(TOKEN.rsplit(".", 1)[0] + ".") == []  # signed by name, but no signature
    assert _kinds("-----BEGIN RSA PRIVATE KEY-----\nnothing\n-----END RSA PRIVATE KEY-----") == []


def _plain_tokens(text):
    """Every place of a header tried, by the json module alone."""
    found = []
    for run in re.finditer(r"[A-Za-z0-9_.-]+", text):
        parts, at, k = run[0].split("."), run.start(), 0
        starts = [at + sum(len(p) + 1 for p in parts[:n]) for n in range(len(parts))]
        while k + 2 < len(parts):
            for skip in range(len(parts[k])):
                head, claims = S._json_object(parts[k][skip:]), S._json_object(parts[k + 1])
                if head and isinstance(head.get("alg"), str) and claims is not None and S.from_base64(parts[k + 2]) is not None:
                    if (head["alg"] == "none") == (parts[k + 2] == ""):
                        found.append((starts[k] + skip, starts[k + 2] + len(parts[k + 2])))
                        k += 2
                    break
            k += 1
    return found


def test_tokens_against_plain_version():
    rng = random.Random(8)
    encode = lambda t: base64.urlsafe_b64encode(t.encode()).rstrip(b"=").decode()
    heads = ['{"alg":"HS256"}', '{ "alg":"RS256"}', '{\n "alg": "ES256",\n "typ": "JWT"}', '{"jwk":{"kty":"RSA"},"alg":"x"}', '{"alg":"none"}',
             '{"typ":"JWT"}', '{"alg":1}', '[{"alg":"x"}]', '{"a":"{","alg":"x"}', '{"alg":"x"}}', "{}"]
    claims = ['{"sub":"1"}', "{}", "[]", '{\r\n}', "x"]
    total = 0
    for _ in range(3000):
        bits = []
        for _ in range(rng.randrange(1, 4)):
            token = ".".join([encode(rng.choice(heads)), encode(rng.choice(claims)), rng.choice(["", "c2lnbmF0dXJl", "AAAAA"])])
            bits += [rng.choice(["", "x", "ab-", "eyJ", " ", "token:", "a.b."]), token, rng.choice(["", ".", ". Then", ".abc", "\n"])]
        text = "".join(bits)
        want = _plain_tokens(text)
        total += len(want)
        assert S.signed_tokens(text) == want, text
    assert total > 300


def test_encrypted_blocks():
    body = base64.b64encode(bytes(range(64))).decode()
    block = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{body}\n-----END RSA PRIVATE KEY-----"
    assert [s for s in S.confirmed_spans(f"key:\n{block}\n") if s[1] == 4] == [(5, 4, 5 + len(block))]
    assert not [s for s in S.confirmed_spans(block.replace(body, body[:-4])) if s[1] == 4]  # no whole blocks
    assert not [s for s in S.confirmed_spans(block.replace("DEK-Info", "Info")) if s[1] == 4]


def test_time_is_linear_in_the_text():
    header = base64.urlsafe_b64encode(b'{"a{' * 200_000 + b"}").rstrip(b"=").decode()
    nested = base64.urlsafe_b64encode(b'{"":' * 200_000 + b"}").rstrip(b"=").decode()
    for text in ("eyJ" * 600_000, f"{header}.e30.", f"{nested}.e30.", "-----BEGIN " * 150_000):
        begun = time.monotonic()
        assert S.confirmed_spans(text) == []
        assert time.monotonic() - begun < 5


def test_base_patterns_against_plain_version():
    rng = random.Random(4)
    bits = ["password", "PassWd", "secret", "api_key", "APIKEY", "tok\u212aen", "token", '"', "'", " ", ":", "=", "abc", "AKIA", "Z9", "0af", "é", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) * rng.choice([1, 1, 1, 4, 12]) for _ in range(rng.randrange(14)))
        assert sorted((a, k, b) for a, k, b in S.base_spans(text)) == sorted(
            (a, S.KINDS.index(k), b) for k, a, b in brute.base_spans(text)
        )


def test_query_matches_plain_version(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smaller one holds no secret
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_secret_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = [k for k, _, _ in brute.base_spans(texts[r["doc_id"]])]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(base.count(k) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == brute.base_digest(texts[r["doc_id"]])
        assert r["spans"] == S.digest_line(S.all_spans(texts[r["doc_id"]]))
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in rows) > 0


def test_redact_edges(frame, spark):
    docs = frame(
        [(1, None, 5), (2, "", 6), (None, "api_key = abcdefgh1 and 0123456789abcdef0123456789abcdef.", 7)],
        "doc_id long, text string, secret_spans int",
    )
    rows = {r["doc_id"]: (r["text"], r["secret_spans"]) for r in S.redact(docs).collect()}
    assert rows == {1: (None, 5), 2: ("", 6), None: ("[assign] and [hex].", 7)}
    assert S.scan(docs).columns.count("secret_spans") == 1
    assert S.scan(spark.createDataFrame([], docs.schema)).count() == 0
    assert S.blank("x" * 500_000) == "x" * 500_000
