"""WARC archives: written one gzip member per record, read back in splits.

Writing. Spark's text sink writes rows as they are, each followed by ``lineSep``. A gzip
member ends with the high byte of its uncompressed size, zero below 16 MiB; that byte is left to
``lineSep``. A larger record gets an empty member after it, which ends in zero too. So
archives are committed like any table, to any file system, and a lost task is run again.

Reading. Spark's text source with the gzip magic as line separator scans byte ranges of the
files for the magic and gives every candidate to the range it starts in, reading past
the end of the range where it must. A candidate is a record if its gzip stream decodes to a WARC
header. The magic also occurs inside compressed data: what follows it there belongs to
the member that is still open. A member open at the end of a range is put together with
the first pieces of the next in a second step; that needs the magic inside the one
record at a boundary and is rare.

Archives must not be named ``*.gz``: Spark would decompress them whole before splitting.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

MAGIC = b"\x1f\x8b\x08"
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)
_NO_ID = 1 << 64

# Fixed values of the WARC 1.1 format.
_VERSION = "WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

RECORD_SCHEMA = (
    "page_id long, record_type string, url string, refers_to long, payload_digest string, payload_bytes long, "
    "payload binary"
)


def record_id(page_id: int | None) -> str:
    """A URN that holds the page's id."""
    return f"<urn:uuid:{uuid.UUID(int=_NO_ID if page_id is None else page_id & (_NO_ID - 1))}>"


def page_of(urn: str) -> int | None:
    value = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    if value >= _NO_ID:
        return None
    return value - _NO_ID if value >> 63 else value


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(
    page_id: int | None, url: str | None, sha1: bytes, size: int, payload: bytes | None, refers_to: int | None, date: str
) -> bytes:
    """One record as a gzip member that ends in a zero byte; a revisit has no payload."""
    if payload is None:
        block, kind = b"", "revisit"
        more = [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_REVISIT_PROFILE}"]
    else:
        block, kind = _HTTP.format(size).encode() + payload, "response"
        more = ["Content-Type: application/http;msgtype=response"]
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        _VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        f"X-Payload-Length: {size}", *more, f"Content-Length: {len(block)}",
    ]
    made = gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)
    return made if made[-1] == 0 else made + _EMPTY_MEMBER


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (null for revisits), size, sha1, refers_to.

    Of pages with equal payloads the smallest page_id is the response; a row that
    repeats it, and a row without page_id, is a response as well.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"))
    pages = pages.select("*", F.length("payload").cast("long").alias("size"), F.unhex(F.sha1("payload")).alias("sha1"))
    first = pages.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = pages.join(first, "sha1", "left")
    revisit = (F.col("size") >= least_bytes) & (F.col("page_id") > F.col("first"))
    return joined.select(
        "page_id", "url", "size", "sha1",
        F.when(~F.coalesce(revisit, F.lit(False)), F.col("payload")).alias("payload"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2025-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` (page_id, url, html; null html is an empty payload), one file per task."""
    prepare(pages.sparkSession)
    names = ["page_id", "url", "sha1", "size", "payload", "refers_to"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [member(*row.values(), date)[:-1] for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    rows = with_record_types(pages, least_bytes).select(*names).mapInArrow(records, "member binary")
    rows.select(F.col("member").cast("string")).write.option("lineSep", "\0").text(path)


def _header(data: bytes) -> bool:
    """Does this gzip stream decode to the start of a WARC record?"""
    try:
        return zlib.decompressobj(31).decompress(data[:4096], 16).startswith(b"WARC/")
    except zlib.error:
        return False


class _Open:
    """A member being read."""

    def __init__(self) -> None:
        self.raw: list[bytes] = []
        self.stream = zlib.decompressobj(31)
        self.data: list[bytes] = []

    def add(self, piece: bytes) -> None:
        self.raw.append(piece)
        self.data.append(self.stream.decompress(piece))


def _record(data: bytes) -> dict:
    """The columns of one decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    size = fields.get("X-Payload-Length")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "record_type": kind,
        "url": fields.get("WARC-Target-URI"),
        "refers_to": page_of(refers) if refers else None,
        # Of what was read where there is a payload, of the header for a revisit.
        "payload_digest": digest(payload) if payload is not None else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": len(payload) if payload is not None else int(size),
        "payload": payload,
    }


def _members(pieces: Iterator[bytes], at_start: bool) -> Iterator[tuple[str, bytes]]:
    """('record', its bytes), or ('piece', raw bytes) for what the range can't decode alone.

    ``pieces``: what follows each magic in one byte range, in order. Pieces before the first record and the
    last member, if it is still open, are passed on raw.
    """
    current: _Open | None = None
    for piece in pieces:
        piece = MAGIC + piece
        if current is not None and not current.stream.eof:
            current.add(piece)
        elif _header(piece) or piece == _EMPTY_MEMBER:
            current = _Open()
            current.add(piece)
        elif current is None and not at_start:
            yield "piece", piece
            continue
        else:
            raise ValueError("gzip member without a WARC header")
        if current.stream.eof and current.data != [b""]:
            yield "record", b"".join(current.data)
    if current is not None and not current.stream.eof:
        yield "piece", b"".join(current.raw)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """RECORD_SCHEMA, one row per record. A member that can't be decoded is an error."""
    prepare(spark)
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    pieces = lines.select(
        F.col("value").cast("binary").alias("piece"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
    )
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    schema = pa.schema(
        [("file", pa.string()), ("range", pa.int64()), ("k", pa.int64()), ("piece", pa.binary())]
        + [(n, pa.binary() if n == "payload" else pa.string() if n in ("record_type", "url", "payload_digest") else pa.int64()) for n in names]
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[tuple[str, int], bytes]]:
            for batch in batches:
                for piece, file, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield (file, start), piece

        out, size = [], 0
        for (file, start), group in groupby(rows(), key=lambda row: row[0]):
            own = (piece for _, piece in group)
            if start == 0:
                next(own)  # what comes before the first magic of a file: nothing
            for k, (kind, data) in enumerate(_members(own, start == 0)):
                row = _record(data) if kind == "record" else {"file": file, "range": start, "k": k, "piece": data}
                out.append(row)
                size += len(data)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    found = pieces.mapInArrow(scanned, f"file string, range long, k long, piece binary, {RECORD_SCHEMA}")

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["range", "k"])
        made = [_record(d) for kind, d in _stitched(group["piece"])]
        return pd.DataFrame(made, columns=names).astype({"refers_to": "Int64", "page_id": "Int64"})

    broken = found.where("piece IS NOT NULL").select("file", "range", "k", "piece")
    whole = found.where("piece IS NULL").select(*names)
    return whole.unionByName(broken.groupBy("file").applyInPandas(joined, RECORD_SCHEMA))


def _stitched(pieces: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """The records of one file that lie across ranges."""
    for kind, data in _members((p[len(MAGIC) :] for p in pieces), True):
        if kind != "record":
            raise ValueError("the last gzip member of an archive is cut off")
        yield kind, data
