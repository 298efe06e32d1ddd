import base64
import hashlib
import os
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from queuelens.llm import archive, tokens
from queuelens.llm.queries import tokenizer_path
from tests.llm import data

PAGES = "page_id bigint, url string, html string, _id string, path string, record_type string"


def pages(spark):
    rows = [(7, "http://a/ b\r\nX: y", "same é"), (3, "http://b", "same é"), (9, None, "same é"), (4, "u", None), (8, "u", ""), (5, "u", "x" * 300_000)]
    rows += [(i, f"http://c/{i}", f"<p>page {i}</p>" * 20) for i in range(100, 160)]
    rows += [(None, "u", "same é"), (None, "u", "only without id"), (-2, "u", "negative")]
    return spark.createDataFrame([r + ("i", "p", "t") for r in rows], PAGES), rows


@pytest.mark.parametrize("least", [0, 10])
def test_archives_round_trip(spark, tmp_path, least):
    df, rows = pages(spark)
    manifest = archive.write_archives(df, min_bytes=least, folder=str(tmp_path), max_bytes=4000)
    assert manifest.count() > 1
    got = archive.read_archives(spark, manifest).collect()
    first = {}
    for key, _, body in rows:
        payload = (body or "").encode()
        if key is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, key), key)
    want = []
    for key, _, body in rows:
        payload = (body or "").encode()
        to = first.get(payload) if len(payload) >= least else None
        to = None if to == key else to
        sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((key, len(payload), sha1, "response" if to is None else "revisit", to, payload if to is None else b""))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_large_ids_beside_nulls_keep_all_bits(spark, tmp_path):
    ids = [2**62 + 1, 2**62 + 3, 2**63 - 1, -(2**62) - 1, -(2**63), 2**53 + 1, None, 5]
    rows = [(key, "u", f"page {i // 2}") for i, key in enumerate(ids)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    for least in (0, 100):  # with revisits, and with responses alone
        manifest = archive.write_archives(df, min_bytes=least, folder=f"{tmp_path}/{least}")
        got = {(r.page_id, r.refers_to) for r in archive.read_archives(spark, manifest).collect()}
        refers = [None, 2**62 + 1, -(2**62) - 1, None, None, -(2**63), 5, None] if least == 0 else [None] * 8
        assert got == set(zip(ids, refers))


def test_archives_of_empty_table(spark, tmp_path):
    df, _ = pages(spark)
    manifest = archive.write_archives(df.limit(0), folder=str(tmp_path))
    assert archive.read_archives(spark, manifest).collect() == []


def test_archive_layout(spark, tmp_path):
    df, _ = pages(spark)
    path = archive.write_archives(df, folder=str(tmp_path)).first().path.removeprefix("file://")
    raw = open(path, "rb").read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    at = 8 + int.from_bytes(raw[4:8], "little")
    body = zstandard.ZstdDecompressor().decompressobj().decompress(raw[8:at])
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body)).decompressobj()
    assert one.decompress(raw[at:]).startswith(b"WARC/1.1\r\n") and one.eof


def good_record(**change):
    body = archive.record(1, "http://x", b"body", archive.digest(b"body"), None, "2024-01-01T00:00:00Z")
    for a, b in change.values():
        assert a in body
        body = body.replace(a, b)
    return body


def test_a_good_record_is_read():
    assert archive.parse(good_record())[1:5] == (1, "http://x", "response", 4)


@pytest.mark.parametrize(
    "a,b",
    [
        (b"WARC/1.1", b"WARC/9"),
        (b"WARC-Date", b"X-Date"),
        (b"Content-Length: 4", b"Content-Length: 5"),
        (b"body\r\n\r\n", b"body\r\n"),
        (b"body\r\n\r\n", b"bodY\r\n\r\n"),
        (b"WARC-Type: response", b"WARC-Type: other"),
        (b"WARC-Date: ", b"WARC-Type: response\r\nWARC-Date: "),
        (b"Content-Type: application", b"Content-Type application"),
        (b"\r\n\r\n", b"\r\n"),
    ],
)
def test_a_broken_record_is_refused(a, b):
    with pytest.raises(archive.WarcError):
        archive.parse(good_record(x=(a, b)))


@pytest.mark.parametrize("cut", [4, 20, -3])
def test_a_cut_archive_is_refused(spark, tmp_path, cut):
    df, _ = pages(spark)
    path = archive.write_archives(df, folder=str(tmp_path)).first().path.removeprefix("file://")
    raw = open(path, "rb").read()
    with open(path + ".cut", "wb") as out:
        out.write(raw[:cut])
    with pytest.raises(archive.WarcError):
        list(archive.records_of("file://" + path + ".cut"))


def test_headers_cannot_be_broken_by_an_address():
    assert archive.clean_uri("http://a/ b\r\nX: y") == "http://a/%20b%0D%0AX:%20y"


def test_ids_equal_the_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs = data.documents(spark)
    odd = ["it's <|endoftext|> A.B., 'S don'T", "ΑΣ ος İx é ́", "x" * 3000, "…, .. ,. a, É, é. 12, 3.5", "a b c\x85d\x1fe"]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    manifest = tokens.write_ids(docs, tokenizer_path(), 1, folder=str(tmp_path), max_docs=10)
    got = tokens.read_ids(spark, manifest).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    encoded = {}
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        encoded.setdefault(key, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(k), *v) for k, vs in encoded.items() for v in vs)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    known = [d for d in order if d is not None]
    assert known == sorted(known) and order[: len(known)] == known


def test_one_document_is_read_through_the_index(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(50)], "doc_id bigint, text string")
    manifest = tokens.write_ids(docs.coalesce(1), tokenizer_path(), 1, folder=str(tmp_path))
    row = manifest.orderBy(F.desc("docs")).first()
    file = tokens.IdFile(row.path)
    place = file.docs // 2
    assert len(file.ids(place)) == 2 * int(file.index["id"][place]) + 1
    file.close()


def test_ids_of_empty_table(spark, tmp_path):
    manifest = tokens.write_ids(data.empty(spark), tokenizer_path(), 1, folder=str(tmp_path))
    assert tokens.read_ids(spark, manifest).collect() == []


def test_a_changed_dictionary_is_refused(spark, tmp_path):
    row = tokens.write_ids(data.documents(spark), tokenizer_path(), 1, folder=str(tmp_path)).first()
    name = next(f for f in os.listdir(tmp_path) if f.endswith(".zdict"))
    with open(tmp_path / name, "ab") as out:
        out.write(b"x")
    with pytest.raises(tokens.IdFileError):
        tokens.IdFile(row.path)
