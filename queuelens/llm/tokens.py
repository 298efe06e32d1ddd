"""Token ids in files: a frame per document under one shared dictionary, an index at the end.

Layout of a file: mark, width of an id, hash of the dictionary; a Zstandard frame of ids per
document; the index (id, null flag, offset, length, number of ids per document) in one frame;
place and size of the index, number of documents, mark. The dictionary lies once beside the
files, named by its hash. A document is read with two small reads: its index entry and frame.
"""

from __future__ import annotations

import hashlib
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import grouped, texts_of
from queuelens.session import materialise, new_table_path

MARK = b"QLIDS001"
HEAD = struct.Struct("<8sI32s")
FOOT = struct.Struct("<QQQ8s")
INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("length", "<u4"), ("count", "<u4")])

BLOCK_BYTES = 2 << 20
CACHED_WORDS = 250_000  #: encoded words that a task keeps, met at least twice
NEW_WORDS = 60_000  #: encoded words met once that wait for their second time
SAMPLE_DOCS = 512  #: documents that the dictionary is trained on at most
SAMPLE_CHARS = 4096  #: characters of each of them; a dictionary only affects the size of the files
DICTIONARY_BYTES = 32768
MANIFEST = "part int, seq int, path string, docs bigint, ids bigint"


class IdFileError(ValueError):
    """A file of ids breaks its format."""


#: The character that stands for each byte in byte-level vocabularies: printable bytes for
#: themselves, the others for code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)).difference(_PRINTABLE)))
}


def latin_word(word: str) -> str | None:
    """The word as the model sees it if it is one of Latin letters, lower-cased and composed."""
    low = word.lower()
    if len(low) == len(word) and low.isalpha() and max(low) < "\u0250" and unicodedata.is_normalized("NFC", low):
        return "".join(map(BYTE_CHARACTERS.__getitem__, low.encode()))
    return None


class WordCache(dict):
    """Ids of a word as bytes; the encoder runs once per word, as long as it is kept.

    Most different words of a corpus occur once. They wait in a short list and are kept only if
    they come again before that list is full, so a worker holds the words that are worth it.
    Sound for tokenizers that never join what white space parts. Words of letters, with at most
    one mark behind, go to the model at once where the tokenizer does no more with them.
    """

    def __init__(self, tokenizer, width: int, limit: int = CACHED_WORDS, new: int = NEW_WORDS):
        super().__init__()
        self.tokenizer, self.tokenize, self.limit = tokenizer, tokenizer.model.tokenize, limit
        self.new, self.most_new = {}, new
        self.kind = {2: "H", 4: "I"}[width]
        # What the short cuts assume of a tokenizer; one that differs encodes whole texts.
        apart = self._ids("ab") + self._ids("c,d") + self._ids("\u00e9e") + self._ids(".")
        self.by_word = self._ids("aB C,d\n \tÉe . ") == apart
        self.plain = self._ids("ab,") == self._ids("ab") + self._ids(",") and all(
            self._ids(w) == [t.id for t in tokenizer.model.tokenize(latin_word(w))]
            for w in ("a", "the", "qzxjkv", "Él", "çaß", "ñandú", "ŒUVRE", "ÿþ", "łódź")
        )

    def _ids(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.kind}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        """``word`` is in lower case as far as it is ASCII."""
        out = self.new.pop(word, None)
        if out is not None:
            if len(self) >= self.limit:
                self.clear()
            self[word] = out
            return out
        if self.plain and word.isalpha():  # of bytes: a-z alone
            out = self._pack([t.id for t in self.tokenize(word.decode())])
        elif self.plain and word[-1] in b",." and (word[:-1].isalpha() or latin_word(word[:-1].decode())):
            out = self[word[:-1]] + self[word[-1:]]
        elif self.plain and (seen := latin_word(word.decode())):
            out = self._pack([t.id for t in self.tokenize(seen)])
        else:
            out = self._pack(self._ids(word.decode()))
        if len(self.new) >= self.most_new:
            self.new.clear()
        self.new[word] = out
        return out


_caches: dict[tuple[str, int], WordCache] = {}


def width_of(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def encoder(path: str, width: int) -> WordCache:
    """The word cache of a tokenizer file; one per Python worker."""
    if (path, width) not in _caches:
        from tokenizers import Tokenizer

        _caches[path, width] = WordCache(Tokenizer.from_file(path), width)
    return _caches[path, width]


def encode(text: bytes, cache: WordCache, end_id: int) -> bytes:
    """All ids of a text and the end id. Special tokens' own strings are left to the tokenizer."""
    end = cache._pack([end_id])
    if not cache.by_word or b"<|" in text:
        return cache._pack(cache._ids(text.decode())) + end
    return b"".join(map(cache.__getitem__, text.lower().split())) + end


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    try:
        return zstandard.train_dictionary(size, [s for s in samples if len(s) >= 16], k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


LEVEL = 3


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """The dictionary is digested once, not for every document."""
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


class _Writer:
    def __init__(self, store, folder: str, width: int, dictionary: bytes):
        self.name = f"{uuid.uuid4().hex}.ids"
        self.handle = store.open_output_stream(f"{folder}/{self.name}")
        self.handle.write(HEAD.pack(MARK, width, hashlib.sha256(dictionary).digest()))
        self.width, self.index, self.ids = width, [], 0

    def add(self, doc_id: int | None, frame: bytes, count: int) -> None:
        self.index.append((doc_id or 0, doc_id is None, self.handle.tell(), len(frame), count))
        self.handle.write(frame)
        self.ids += count

    def close(self) -> None:
        body = zstandard.ZstdCompressor(level=3).compress(np.array(self.index, dtype=INDEX).tobytes())
        at = self.handle.tell()
        self.handle.write(body)
        self.handle.write(FOOT.pack(at, len(body), len(self.index), MARK))
        self.handle.close()


def write_ids(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    max_docs: int = 500_000,
    max_bytes: int = 256 << 20,
) -> DataFrame:
    """Encode every text and write ids in ascending order of documents; returns the manifest
    (part, seq, path, docs, ids, start), ``start`` being the ids of all files before.

    Null texts are empty: the end id alone. Rows of one id lie by their text's hash, rows
    without an id behind all others. ``tokenizer`` is a file that every executor has. An empty
    table gives no file.
    """
    spark = docs.sparkSession
    place = _uri(folder or new_table_path(spark, "ids"))
    width = width_of(tokenizer)
    given = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    heads = given.select(F.left("_text", F.lit(SAMPLE_CHARS)).alias("_head")).where("_head <> ''").limit(SAMPLE_DOCS).collect()
    dictionary = train([encode(row[0].encode(), encoder(tokenizer, width), end_id) for row in heads])
    store, base = pafs.FileSystem.from_uri(place)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)
    order = [F.col("_id").asc_nulls_last(), F.xxhash64("_text")]
    ordered = given.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(place)
        cache, squeeze = encoder(tokenizer, width), compressor(dictionary)
        part, seq, file = TaskContext.get().partitionId(), 0, None

        def done():
            file.close()
            row = {"part": [part], "seq": [seq], "path": [f"{place}/{file.name}"], "docs": [len(file.index)], "ids": [file.ids]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

        for block in grouped(batches, "_text", BLOCK_BYTES):
            for key, body in zip(block["_id"].to_pylist(), texts_of(block["_text"].combine_chunks())):
                file = file or _Writer(store, base, width, dictionary)
                ids = encode(body, cache, end_id)
                file.add(key, squeeze.compress(ids), len(ids) // width)
                if len(file.index) >= max_docs or file.handle.tell() >= max_bytes:
                    yield done()
                    seq, file = seq + 1, None
        if file is not None:
            yield done()

    manifest = materialise(ordered.mapInArrow(write, MANIFEST), "id-files")
    # One row per file: the running sum is over files, not documents.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class IdFile:
    """Reads one file: any document through the index, or all in order."""

    def __init__(self, path: str):
        self.store, name = pafs.FileSystem.from_uri(_uri(path))
        self.handle = self.store.open_input_file(name)
        mark, self.width, said = HEAD.unpack(self._bytes(0, HEAD.size))
        size = self.handle.size()
        at, length, self.docs, end = FOOT.unpack(self._bytes(size - FOOT.size, FOOT.size))
        if mark != MARK or end != MARK or self.width not in (2, 4):
            raise IdFileError(f"{path} is not a file of ids")
        with self.store.open_input_stream(f"{name.rpartition('/')[0]}/{said.hex()}.zdict") as handle:
            dictionary = handle.read()
        if hashlib.sha256(dictionary).digest() != said:
            raise IdFileError(f"{path}: the dictionary is not the one it was written with")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._bytes(at, length)), INDEX)
        if len(self.index) != self.docs:
            raise IdFileError(f"{path}: {len(self.index)} index entries for {self.docs} documents")
        self.decoder = decompressor(dictionary)

    def _bytes(self, at: int, size: int) -> bytes:
        data = self.handle.read_at(size, at)
        if len(data) != size:
            raise IdFileError("the file is too short")
        return data

    def ids(self, place: int) -> np.ndarray:
        """The ids of the document at ``place`` in the index."""
        entry = self.index[place]
        data = self.decoder.decompress(self._bytes(int(entry["offset"]), int(entry["length"])))
        if len(data) != int(entry["count"]) * self.width:
            raise IdFileError("a document has another number of ids than the index says")
        return np.frombuffer(data, f"<u{self.width}")

    def close(self) -> None:
        self.handle.close()


def read_ids(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""
    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path, start, docs in zip(rows.path, rows.start, rows.docs):
                file = IdFile(path)
                if file.docs != docs:
                    raise IdFileError(f"{path} has {file.docs} documents, the manifest {docs}")
                counts = file.index["count"].astype(np.int64)
                sums = np.array([zlib.crc32(file.ids(k).astype("<u4").tobytes()) for k in range(file.docs)], np.int64)
                file.close()
                ids = pd.array(file.index["id"].astype(np.int64), dtype="Int64")
                ids[file.index["null"].astype(bool)] = pd.NA
                yield pd.DataFrame(
                    {"doc_id": ids, "start": int(start) + np.cumsum(counts) - counts, "n_tokens": counts, "ids_crc32": sums}
                )

    return manifest.select("path", "start", "docs").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInPandas(read, kind)
