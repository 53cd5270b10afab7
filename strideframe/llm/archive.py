"""Content-addressed WARC archive: payload bytes once by digest, exact record headers beside them.

``write_archive`` makes two Parquet tables below one folder. ``payloads`` holds every different payload once, zstd
compressed, under its SHA-256. ``records`` holds one row per record with the exact header block and the digest.
``read_archive`` joins them again, checks length and digest of every payload and returns whole WARC records.

Records with equal payloads of at least ``least`` bytes: the one with the smallest id is the response, the others are
revisits that name it; smaller payloads are all responses. Both tables are joined by shuffle on the digest; copies of a
payload collapse in each task before they travel, and adaptive execution splits a digest that very many records share.

Control characters and line ends in a url are percent-encoded in its header. Payloads of any length are whole: one
record is one row. Nulls and repeats: a null payload is empty; a null url gives no WARC-Target-URI; a row without id is a response only if
no row with its payload has an id, and is never referred to; rows that share the smallest id are all responses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0
# fixed values: the alphabet of RFC 4648 base32
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


#: characters that some reader takes for a line end, and all control characters
_UNSAFE = tuple(chr(c) for c in [*range(0x20), 0x7F, *range(0x80, 0xA0), 0x2028, 0x2029])


def _percent_encoded(url: Column) -> Column:
    """The address with each unsafe character as its UTF-8 bytes, percent-encoded."""
    for c in _UNSAFE:
        url = F.replace(url, F.lit(c), F.lit("".join(f"%{b:02X}" for b in c.encode())))
    return url


def base32_of_hex(digest: Column) -> Column:
    """Base32 of 40 hexadecimal digits: every five digits are four characters."""
    out = []
    for k in range(8):
        part = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.pmod(F.shiftright(part, shift), F.lit(32)) + 1
            out.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*out)


def _lines(pairs: list[tuple[str, Column]]) -> Column:
    """Header lines; a field whose value is null is left out."""
    fields = [F.concat(F.lit(f"{name}: "), value) for name, value in pairs]
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"))


def record_headers(pages: DataFrame, id: str, url: str, payload: str, least: int, date: str) -> DataFrame:
    """``id, digest, header`` for every row."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(id).alias("id"), F.col(url).cast("string").alias("url"), F.sha2(body, 256).alias("digest"),
        base32_of_hex(F.sha1(body)).alias("sha1"), F.octet_length(body).cast("long").alias("size"),
    )
    first = rows.groupBy("digest").agg(F.min("id").alias("first"))
    revisit = (F.col("size") >= least) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    # control characters and line ends in an address would break the header
    address = F.when(F.col("url").rlike(f"[{''.join(_UNSAFE)}]"), _percent_encoded(F.col("url"))).otherwise(F.col("url"))
    header = _lines(
        [
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", address),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
            ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
            ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("Content-Type", F.lit("text/html; charset=utf-8")),
            ("Content-Length", F.col("size").cast("string")),
        ]
    )
    return rows.join(first, "digest").select("id", "digest", "size", header.alias("header"))


def payloads(pages: DataFrame, payload: str) -> DataFrame:
    """``digest, size, packed``: every different payload once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                raw = [v.as_py() or b"" for v in batch.column("body").slice(at, 256)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "digest": pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string()),
                        "size": pa.array([len(b) for b in raw], pa.int64()),
                        "packed": pa.array([tool.compress(b) for b in raw], pa.binary()),
                    }
                )

    body = pages.select(F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("body"))
    packed = body.mapInArrow(pack, "digest string, size long, packed binary")
    return packed.groupBy("digest").agg(F.first("size").alias("size"), F.first("packed").alias("packed"))


def write_archive(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST,
    date: str = "2026-01-01T00:00:00Z",
) -> None:
    """Write the two tables below ``folder`` (a place that all executors reach)."""
    record_headers(pages, id, url, payload, least, date).write.parquet(f"{folder}/records")
    payloads(pages, payload).write.parquet(f"{folder}/payloads", compression="uncompressed")  # packed already


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``id, header, payload`` for every record, digest and length verified; a damaged or missing payload is an error."""
    records = spark.read.parquet(f"{folder}/records")
    stored = spark.read.parquet(f"{folder}/payloads").withColumnRenamed("size", "stored_size")
    kind = records.schema["id"].dataType

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = []
                for packed, size, digest in zip(part.column("packed"), part.column("size"), part.column("digest")):
                    if not packed.is_valid:
                        raise ValueError(f"no payload is stored for {digest.as_py()}")
                    body = tool.decompress(packed.as_py(), max_output_size=size.as_py())
                    if len(body) != size.as_py() or hashlib.sha256(body).hexdigest() != digest.as_py():
                        raise ValueError(f"stored payload of {digest.as_py()} is damaged")
                    raw.append(body)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("header"), pa.array(raw, pa.binary())], names=["id", "header", "payload"]
                )

    whole = records.join(stored, "digest", "left").select("id", "header", "digest", "size", "packed")
    return whole.mapInArrow(unpack, f"id {kind.simpleString()}, header string, payload binary")


def record_bytes(header: Column, payload: Column) -> Column:
    """The whole record as it stands in a WARC file."""
    return F.concat(header.cast("binary"), payload, F.lit("\r\n\r\n").cast("binary"))


def header_field(header: Column, name: str) -> Column:
    value = F.regexp_extract(header, rf"(?d)(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def export_warc(records: DataFrame, folder: str) -> None:
    """Write the records of :func:`read_archive` as gzip WARC files. Payloads must be UTF-8 text."""
    end = "\r\n\r\n"
    records.select(F.concat(F.col("header"), F.col("payload").cast("string")).alias("value")).write.option(
        "lineSep", end
    ).text(folder, compression="gzip")
