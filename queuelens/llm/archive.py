"""WARC archives in Zstandard: one frame per record, dictionary in a leading skippable frame.

The writer runs inside Spark tasks. A file gets a name of its own per attempt; only the
manifest that Spark commits says which files count, so a lost or repeated task leaves no
trace in the result. The reader needs nothing but the files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.session import materialise, new_table_path

# The formats' own marks.
SKIPPABLE_DICTIONARY = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

SAMPLE_RECORDS = 256  #: pages that a dictionary is trained on at most
SAMPLE_BYTES = 16384  #: bytes of each of them; a dictionary only affects the size of the files
CHUNK = 1 << 16

MANIFEST = "path string, records bigint, bytes bigint"
RECORDS = (
    "record_id string, page_id bigint, uri string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


class WarcError(ValueError):
    """An archive breaks its format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A record's URN: the id in the low half, which can be read back; random where there is none."""
    if page_id is None:
        return f"urn:uuid:{uuid.UUID(int=(2 << 126) | (uuid.uuid4().int >> 2))}"
    return f"urn:uuid:{uuid.UUID(int=(1 << 126) | (page_id & (1 << 64) - 1))}"


def page_of(urn: str) -> int | None:
    value = uuid.UUID(urn.removeprefix("urn:uuid:")).int
    low = value & (1 << 64) - 1
    return None if value >> 126 != 1 else low - (1 << 64) if low >> 63 else low


def clean_uri(uri: str) -> str:
    """No control character or blank may break a header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri)


def record(page_id, uri, payload: bytes, payload_digest: str, refers_to, date: str) -> bytes:
    """One whole record, response or (with ``refers_to``) revisit without its payload."""
    http = HTTP_HEAD.format(len(payload)).encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page_id)}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", clean_uri(uri))] if uri else []),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        *([("WARC-Block-Digest", f"sha1:{digest(block)}")] if refers_to is None else []),
        *([("WARC-Refers-To", f"<{record_id(refers_to)}>"), ("WARC-Profile", REVISIT_PROFILE)] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _split_head(data: bytes, what: str) -> tuple[list[bytes], bytes]:
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError(f"{what} has no end of its header")
    return head.split(b"\r\n"), rest


def _fields(lines: list[bytes], what: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise WarcError(f"{what}: bad header line")
        if name.strip().lower() in out:
            raise WarcError(f"{what}: header {name} occurs twice")
        out[name.strip().lower()] = value.strip()
    return out


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise WarcError(f"{what}: no valid Content-Length")
    return int(value)


def parse(data: bytes) -> tuple:
    """A record's row, after checks of version, headers, lengths and digests."""
    lines, rest = _split_head(data, "record")
    if lines[0] != VERSION:
        raise WarcError(f"record starts with {lines[0][:20]!r}")
    fields = _fields(lines[1:], "record")
    if missing := [name for name in REQUIRED if name not in fields]:
        raise WarcError(f"record lacks {missing}")
    size = _length(fields, "record")
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise WarcError(f"record of {len(rest)} bytes, Content-Length {size}")
    kind = fields["warc-type"]
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    http, payload = _split_head(block, "response")
    http_size = _length(_fields(http[1:], "response"), "response")
    refers = None
    if kind == "response":
        if len(payload) != http_size:
            raise WarcError(f"payload of {len(payload)} bytes, said to be {http_size}")
        if digest(payload) != said:
            raise WarcError("payload and digest differ")
        if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
            raise WarcError("block and digest differ")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise WarcError("a revisit has a payload or refers to nothing")
        refers = page_of(fields["warc-refers-to"].strip("<>"))
    else:
        raise WarcError(f"record type {kind}")
    urn = fields["warc-record-id"].strip("<>")
    return urn, page_of(urn), fields.get("warc-target-uri"), kind, http_size, said, refers, payload


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=9).compress(dictionary) if dictionary else b""
    return struct.pack("<II", SKIPPABLE_DICTIONARY, len(body)) + body


def _exactly(handle, size: int) -> bytes:
    data = handle.read(size)
    if len(data) != size:
        raise WarcError("the file ends inside its dictionary frame")
    return data


def frames(handle) -> Iterator[bytes]:
    """The content of each frame of an open archive. Memory: one record and one chunk."""
    magic, size = struct.unpack("<II", _exactly(handle, 8))
    if magic != SKIPPABLE_DICTIONARY:
        raise WarcError("no dictionary frame at the start")
    body = _exactly(handle, size)
    if body.startswith(ZSTD_FRAME):
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    shared = {"dict_data": zstandard.ZstdCompressionDict(body)} if body else {}
    decoder, rest = zstandard.ZstdDecompressor(**shared), b""
    while True:
        rest = rest or handle.read(CHUNK)
        if not rest:
            return
        frame, out = decoder.decompressobj(), []
        while True:
            out.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            rest = handle.read(CHUNK)
            if not rest:
                raise WarcError("the file ends inside a frame")
        yield b"".join(out)


def records_of(path: str) -> Iterator[tuple]:
    store, name = pafs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as handle:
        for data in frames(handle):
            yield parse(data)


def train(payloads: list[bytes], size: int = 16384) -> bytes:
    """A dictionary of some payloads, empty if they are too few."""
    samples = [p for p in payloads if len(p) >= 64]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, page_id: str, uri: str, html: str, min_bytes: int) -> DataFrame:
    """(_id, _uri, _payload, _sha1, _refers): which page each record refers to, null for a response.

    The least id per digest comes from a count with map-side combination. Only digests that
    occur more than once take part in the join; AQE splits a digest that many pages share.
    """
    given = pages.select(
        F.col(page_id).cast("bigint").alias("_id"),
        F.col(uri).cast("string").alias("_uri"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("_payload"),
    ).withColumn("_sha1", F.sha1("_payload"))
    first = (
        given.where(F.octet_length("_payload") >= min_bytes)
        .groupBy("_sha1")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select("_sha1", "_first")
    )
    return given.join(first, "_sha1", "left").withColumn(
        "_refers", F.when(~F.col("_id").eqNullSafe(F.col("_first")), F.col("_first"))
    ).drop("_first")


def write_archives(
    pages: DataFrame,
    page_id: str = "page_id",
    uri: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    max_bytes: int = 256 << 20,
    date: str = "2024-01-01T00:00:00Z",
    folder: str | None = None,
) -> DataFrame:
    """Write a record per page to archives of about ``max_bytes``; returns their manifest (path, records, bytes).

    Of equal payloads of at least ``min_bytes`` the page with the least id is a response, the
    others are revisits. Null html is an empty payload. Rows that repeat a response's id and
    payload are responses too. A null id is never the least; pages with null ids alone are
    responses. An empty table gives no archive.
    """
    spark = pages.sparkSession
    ready = with_revisits(pages, page_id, uri, html, min_bytes)
    head = pages.select(F.substring(F.col(html).cast("binary"), 1, SAMPLE_BYTES).alias("_head")).where("_head is not null")
    dictionary = train([bytes(row[0]) for row in head.limit(SAMPLE_RECORDS).collect()])
    place = folder or new_table_path(spark, "archives")
    if "://" not in place and not place.startswith("file:"):
        place = f"file://{place}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        encoder = zstandard.ZstdCompressor(level=3, write_checksum=True, **shared)
        store, base = pafs.FileSystem.from_uri(place)
        store.create_dir(base, recursive=True)
        handle = None
        for rows in batches:
            for key, address, payload, sha1, refers in zip(rows._id, rows._uri, rows._payload, rows._sha1, rows._refers):
                if handle is None:
                    name, count = f"{uuid.uuid4().hex}.warc.zst", 0
                    handle = store.open_output_stream(f"{base}/{name}", compression=None)
                    handle.write(dictionary_frame(dictionary))
                said = base64.b32encode(bytes.fromhex(sha1)).decode()
                key = None if pd.isna(key) else int(key)
                refers = None if pd.isna(refers) else int(refers)
                handle.write(encoder.compress(record(key, address, bytes(payload), said, refers, date)))
                count += 1
                if (size := handle.tell()) >= max_bytes:
                    handle.close()
                    handle = None
                    yield pd.DataFrame({"path": [f"{place}/{name}"], "records": [count], "bytes": [size]})
        if handle is not None:
            handle.close()
            yield pd.DataFrame({"path": [f"{place}/{name}"], "records": [count], "bytes": [size]})

    as_text = ready.select(F.col("_id").cast("string"), "_uri", "_payload", "_sha1", F.col("_refers").cast("string"))
    return materialise(as_text.mapInPandas(write, MANIFEST), "manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of the listed archives, one row each. A broken archive stops the job with ``WarcError``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RECORDS.split(", ")]
        for rows in batches:
            for path, expected in zip(rows.path, rows.records):
                held, size, count = [], 0, 0
                for row in records_of(path):
                    held.append(row if keep_payload else (*row[:-1], None))
                    size += len(row[-1]) if keep_payload else 100
                    count += 1
                    if size >= 4 << 20:
                        yield _frame(held, names)
                        held, size = [], 0
                if held:
                    yield _frame(held, names)
                if count != expected:
                    raise WarcError(f"{path} has {count} records, the manifest {expected}")

    return manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInPandas(read, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Ids go straight into nullable integers: pandas makes ints beside None floats, which hold 53 bits."""
    columns = dict(zip(names, zip(*rows)))
    return pd.DataFrame({n: pd.array(c, dtype="Int64") if n in ("page_id", "refers_to") else list(c) for n, c in columns.items()})
