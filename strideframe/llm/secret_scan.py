"""Find secrets in whole texts: three base patterns, and candidates confirmed by their structure.

Base kinds, leftmost and non-overlapping within each kind: ``assign`` (a named value of 8 or more characters),
``access`` (an access key id of 16 or more), ``hex`` (32 or more digits). The method adds kinds that are reported only
after decoding: ``jwt`` (three base64url parts, the first a JSON object with an ``alg``, the second a JSON object),
``pem`` (a key block whose body decodes to nested DER, an OpenSSH key or a PKCS8 container, or an encrypted block that
names its cipher and start value) and ``key`` (a base64 or hex run that decodes to a DER structure whose lengths nest exactly, or to an SSH key blob). A base64 run is taken whole, in
both alphabets together; if it is no key, its parts of one alphabet are tried. Lines of base64 that follow one another,
all but the last of one length, are tried joined, also when quoted by a mark or indented. Spans are code points, the
end exclusive.

Nulls: a null text is empty and has no spans. Equal rows have equal spans. Columns of any other name pass through
:func:`redact`.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: the base patterns
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # equal to all runs of [0-9a-f]+ of 32 and more: a run is never entered half-way

#: parts of one base64url alphabet with dots between them; a match is never entered half-way
DOTTED = re.compile(r"[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}+")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*(?:PRIVATE KEY|PUBLIC KEY|CERTIFICATE))-----([A-Za-z0-9+/=\s]*)-----END \1-----")
ENCRYPTED = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----\s*Proc-Type: 4,ENCRYPTED\s*DEK-Info: [A-Z0-9-]+,([0-9A-Fa-f]{16,})\s([A-Za-z0-9+/=\s]*)-----END \1-----"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
PARTS = (re.compile(r"[A-Za-z0-9+/]{32,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{32,}={0,2}"))
#: a run of base64 up to the end of its line, and a following line that begins with one
_LINE_END = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?=[\x20\t\r]*\n)")
_NEXT_LINE = re.compile(r"[\x20\t\r]*\n[\x20\t>|#*]*([A-Za-z0-9+/_-]++={0,2})(?![A-Za-z0-9+/_=-])")
LONG_HEX = re.compile(r"[0-9A-Fa-f]{32,}")

KINDS = ("assign", "access", "hex", "jwt", "pem", "key")
BASE_KINDS = 3
Span = tuple[int, int, int]  # start, place of the kind, end

_TAGS = {0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x0C, 0x13, 0x17, 0x18, 0x30, 0x31, 0xA0, 0xA1, 0xA2, 0xA3, 0x80, 0x81, 0x82}


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def from_base64(text: str) -> bytes | None:
    """Standard or URL alphabet, padding optional, white space allowed between characters."""
    plain = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, depth: int = 0) -> int | None:
    """Number of DER values when ``data`` is nothing but whole values whose constructed ones nest exactly; else None."""
    count, at = 0, 0
    while at < len(data):
        tag = data[at]
        if tag not in _TAGS or at + 2 > len(data):
            return None
        size, at = data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        count += 1
        if tag in (0x30, 0x31) or 0xA0 <= tag <= 0xA3:
            inner = der_items(data[at : at + size], depth + 1) if depth < 16 else None
            if inner is None:
                return None
            count += inner
        at += size
    return count


def is_der_key(data: bytes) -> bool:
    """One outer sequence over the whole value, holding at least an integer or a sequence first and two values in all."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    items = der_items(data)
    head = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    return items is not None and items >= 3 and len(data) > head and data[head] in (0x02, 0x30)


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key, or a public key blob of length-prefixed fields that fill it exactly."""
    if data.startswith(b"openssh-key-v1\0"):
        return True
    fields, at = [], 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if size > len(data) - at - 4:
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) >= 2 and fields[0].startswith((b"ssh-", b"ecdsa-sha2-", b"sk-"))


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def _is_cipher_text(body: str) -> bool:
    """Whole blocks of eight bytes."""
    data = from_base64(body)
    return bool(data) and len(data) % 8 == 0


def _json_object(part: str) -> dict | None:
    data = from_base64(part)
    try:
        value = json.loads(data.decode("utf-8")) if data is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


#: one lexical part of JSON
_JSON_PART = re.compile(r'[\x20\t\r\n]*+(?:([{\[])|([}\]])|[,:]|"(?:[^"\\\x00-\x1f]|\\.)*+"|[-+0-9.eE]++|true|false|null)')


def _closes(text: str, at: int) -> tuple[bool, int]:
    """Whether the brackets that open at ``at`` close again, and how far the text was read for that."""
    depth = 0
    while part := _JSON_PART.match(text, at):
        at = part.end()
        depth += 1 if part[1] else -1 if part[2] else 0
        if depth == 0:
            return True, at
    return False, at


def _header_start(part: str) -> int | None:
    """The first place in ``part`` from which it decodes to one JSON object with an ``alg``, up to the part's end.

    Each of the four ways to group the characters is decoded once. An object that does not close, or closes early, rules
    out all objects begun inside what was read, so nothing is read twice. (An object written inside a JSON string that
    does not end is not looked for.)
    """
    found = None
    for skip in range(min(4, len(part))):
        data = from_base64(part[skip:])
        if data is None or not data.endswith(b"}"):
            continue
        text, at = data.decode("latin-1"), 0
        while (at := text.find("{", at)) >= 0:
            if at % 3:
                at += 1
                continue
            closed, end = _closes(text, at)
            if closed and end == len(text):
                start = skip + at // 3 * 4
                head = _json_object(part[start:])
                if head is not None and isinstance(head.get("alg"), str) and (found is None or start < found):
                    found = start
                break
            at = max(end, at + 1)
    return found


_FIRST = tuple("eICD")


def signed_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of tokens: a header with an ``alg``, claims that are an object, and a signature unless the ``alg`` is none."""
    found = []
    for m in DOTTED.finditer(text):
        parts, start, k = m[0].split("."), m.start(), 0
        places = [start]
        for part in parts:
            places.append(places[-1] + len(part) + 1)
        while k + 2 < len(parts):
            claims, signature = parts[k + 1], parts[k + 2]
            # "{" or white space comes first in the claims
            begin = _header_start(parts[k]) if claims[:1] in _FIRST and _json_object(claims) is not None else None
            if begin is not None and from_base64(signature) is not None:
                plain = _json_object(parts[k][begin:])["alg"].lower() == "none"
                if plain == (signature == ""):
                    found.append((places[k] + begin, places[k + 2] + len(signature)))
                    k += 2
            k += 1
    return found


def _whole_or_parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The run if it is a key, else those of its parts of one alphabet that are."""
    if is_key(from_base64(text[start:end])):
        return [(start, end)]
    found: list[tuple[int, int]] = []
    for pattern in PARTS:
        for m in pattern.finditer(text, start, end):
            free = all(m.end() <= a or b <= m.start() for a, b in found)
            if free and (m.start(), m.end()) != (start, end) and is_key(from_base64(m[0])):
                found.append((m.start(), m.end()))
    return found


def _lines_of_key(first: str, left: int) -> tuple[int, ...]:
    """Numbers of lines, out of ``left``, that a key beginning with the line ``first`` may fill; none if it begins none.

    DER states its length, so a line that is none costs no more than the bytes its header asks for.
    """
    data = from_base64(first[: len(first) // 4 * 4]) or b""
    if data[:1] == b"\x30":
        size, head = data[1], 2
        if size & 0x80:
            head += size & 0x7F
            size = int.from_bytes(data[2:head], "big") if 2 < head <= 6 else left * len(first)
        chars = -(-(head + size) * 4 // 3)
        lines = -(-chars // len(first))
        return (lines,) if 1 < lines <= left else ()
    if data.startswith(b"openssh-key-") or data[4:8] in (b"ssh-", b"ecds", b"sk-s", b"sk-e"):
        return tuple(n for n in (left, left - 1) if n > 1)  # a line behind the key may look like one of its lines
    return ()


def wrapped_keys(text: str) -> list[tuple[int, int]]:
    """Keys over several lines, all of one length but a last one that may be shorter."""
    found, at = [], 0
    while first := _LINE_END.search(text, at):
        lines, width = [(first.start(), first.end())], first.end() - first.start()
        while follow := _NEXT_LINE.match(text, lines[-1][1]):
            if len(follow[1]) > width:
                break
            lines.append(follow.span(1))
            if len(follow[1]) < width:
                break
        at, k = lines[-1][1], 0
        if len(lines) > 1 and lines[-1][1] - lines[-1][0] < width:
            at = lines[-1][0]  # a shorter line may begin another key
        while k < len(lines) - 1:
            for n in _lines_of_key(text[slice(*lines[k])], len(lines) - k):
                if is_key(from_base64("".join(text[a:b] for a, b in lines[k : k + n]))):
                    found.append((lines[k][0], lines[k + n - 1][1]))
                    at, k = max(at, lines[k + n - 1][1]), k + n - 1
                    break
            k += 1
    return found


def confirmed_spans(text: str) -> list[Span]:
    """Spans whose decoded content has the structure of a key or a signed token."""
    found = []
    if "." in text:
        found += [(a, 3, b) for a, b in signed_tokens(text)]
    blocks = []
    if "-----BEGIN " in text:
        blocks = [(m.start(), 4, m.end()) for m in PEM.finditer(text) if is_key(from_base64(m[2]))]
        blocks += [(m.start(), 4, m.end()) for m in ENCRYPTED.finditer(text) if len(m[2]) % 2 == 0 and _is_cipher_text(m[3])]
    joined = wrapped_keys(text) if "\n" in text else []
    spots = [(a, 5, b) for m in BASE64.finditer(text) for a, b in _whole_or_parts(text, m.start(), m.end())]
    spots = [s for s in spots if not any(a <= s[0] < b for a, b in joined)] + [(a, 5, b) for a, b in joined]
    taken = {s[0] for s in spots}
    for m in LONG_HEX.finditer(text):
        if m.start() not in taken and (m.end() - m.start()) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            spots.append((m.start(), 5, m.end()))
    inside = lambda s: any(b[0] <= s[0] < b[2] for b in blocks)
    return found + blocks + [s for s in spots if not inside(s)]


def all_spans(text: str) -> list[Span]:
    return sorted(base_spans(text) + confirmed_spans(text))


def digest_line(spans: list[Span]) -> str:
    """``kind:start:end`` by start, then by kind as listed, joined by commas."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _map(docs: DataFrame, schema: T.StructType, row: Callable[[str], dict], text: str) -> DataFrame:
    """Add the fields of ``row(text)`` to every row."""
    names = [f.name for f in schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(at, 512)
                rows = [row(v.as_py() or "") for v in part.column(text)]
                kept = {n: part.column(n) for n in part.schema.names if n not in names}
                types = {n: _ARROW[f.dataType.simpleString()] for n, f in zip(names, schema.fields)}
                made = {n: pa.array([r[n] for r in rows], types[n]) for n in names}
                yield pa.RecordBatch.from_pydict(kept | made)

    kept = T.StructType([f for f in docs.schema.fields if f.name not in names])
    return docs.mapInArrow(work, T.StructType(kept.fields + schema.fields))


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
_ARROW = {
    "string": pa.string(),
    _SPANS.simpleString(): pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
}


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``, an array of (kind, start, end) in order."""
    schema = T.StructType([T.StructField("secret_spans", _SPANS)])
    return _map(
        docs, schema, lambda t: {"secret_spans": [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(t)]}, text
    )


def blank(text: str) -> str:
    """The text with every secret replaced by a mark that names its kind; overlapping spans become one."""
    out, at, spans = [], 0, all_spans(text)
    while spans:
        start, kind, end = spans.pop(0)
        while spans and spans[0][0] < end:
            end = max(end, spans.pop(0)[2])
        out += [text[at:start], f"[{KINDS[kind]}]"]
        at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the secrets in ``text`` blanked; a null text stays null, other columns and their order are kept."""
    order = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(at, 512)
                new = pa.array([None if v.as_py() is None else blank(v.as_py()) for v in part.column(text)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [new if n == text else part.column(n) for n in part.schema.names], names=part.schema.names
                )

    return docs.mapInArrow(work, docs.schema).select(*order)
