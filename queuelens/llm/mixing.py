"""Mix sources to target weights by fixed-length blocks.

The words of a source, its documents in a fixed order, are cut into blocks of ``block_words``.
A mix is a list of slots, dealt over output shards: each shard draws from a multinomial how
many of its slots come from each source, the weights being what each source still has to give,
so the totals come out exactly. The j-th slot of a source is block perm(j mod n) of its n
blocks; perm is a keyed Feistel permutation, another one per pass over the source. Slots and
blocks meet by a join on the block's index. The shards are written with their blocks' words;
what a mix takes of each row is read from them. On their way texts and words are Zstandard frames
under one dictionary, so that what a shuffle leaves on disk stays below the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelens.functions.lookup import bounded_rows
from queuelens.llm import tokens
from queuelens.llm.common import WORD, grouped, packed, texts_of, words
from queuelens.session import materialise

CHUNKS = 1024  #: pieces of a source whose running sums are taken apart from each other
GROUPS = 1024  #: spans of shards at most, whose totals are drawn first, so that spans can be filled side by side
SPAN = 4  #: shards of a span at least
BLOCK_BYTES = 2 << 20
SAMPLE_DOCS = 1024  #: texts that the dictionary is trained on at most
SAMPLE_CHARS = 4096  #: characters of each of them; a dictionary only affects the bytes that move
DICTIONARY_BYTES = 112 << 10
MAX_SOURCES = 10_000  #: sources are listed on the driver; more raise an error


class Mix(NamedTuple):
    """A planned mix: ``spans`` places each row with words on its source's line of words, ``draws``
    has a row per slot, ``rows`` every row of the input with its source's figures. ``shards`` is the
    mix itself, written by shard and slot: (shard, slot, _no, pass, _block, words, _parts), the parts
    being the rows' words [a, b) that the block is made of, each row by its ``_start``. ``sources``
    numbers the sources (_no, _name)."""

    spans: DataFrame
    draws: DataFrame
    rows: DataFrame
    shards: DataFrame
    sources: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights: list[float], most: float = 3) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``most`` times its size; what is cut
    off goes to the others by weight until none is above."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def slots_wanted(size: int, target: float, block: int) -> int:
    """Whole passes over a source, then blocks for the rest."""
    if size == 0:
        return 0
    blocks, passes = -(-size // block), int(target // size)
    return passes * blocks + min(blocks, round((target - passes * size) / block))


def draw(rng: np.random.Generator, count: int, left: np.ndarray) -> np.ndarray:
    """Multinomial counts with weights ``left``, none above what is left."""
    out = np.zeros_like(left)
    count = min(count, int(left.sum()))
    while (need := count - int(out.sum())) > 0:
        rest = left - out
        out = np.minimum(left, out + rng.multinomial(need, rest / rest.sum()))
    return out


def permuted(places: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size) at ``places``: four Feistel rounds over the least
    even number of bits, walked on until the value is in range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.SeedSequence(key).generate_state(4, np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            h = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h ^ (h >> np.uint64(32))) & low)
        return left << np.uint64(half) | right

    out = once(places.astype(np.uint64))
    while (outside := out >= size).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def plan_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=lambda i: 1 + i % 3,
    most: int = 3,
    block_words: int = 64,
    shard_slots: int = 8192,
    seed: int = 42,
) -> Mix:
    """Plan a mix of all documents.

    Sources are ordered by code point, null last; the i-th weighs ``weights(i)``. Null and blank
    texts have no words: they are in ``rows`` only. Equal rows are separate rows. Rows of one
    source lie by a hash of id and text, so the mix does not depend on files or partitions. An
    empty table, or one without words, has no slots.
    """
    spark = docs.sparkSession
    given = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"),
        F.col(source).cast("string").alias("_source"),
        word_count(F.col(text).cast("string")).alias("_size"),
        F.xxhash64(F.col(text).cast("string")).alias("_tie"),
    )
    sized = materialise(given, "mix-sizes")
    found = bounded_rows(sized.groupBy("_source").agg(F.sum("_size").alias("n")), MAX_SOURCES, "sources")
    found.sort(key=lambda row: (row[0] is None, row[0] or ""))
    sizes = [int(row[1]) for row in found]
    goal = targets(sizes, [weights(i) for i in range(len(found))], most)
    blocks = [-(-n // block_words) for n in sizes]
    wanted = np.array([slots_wanted(n, t, block_words) for n, t in zip(sizes, goal)], dtype=np.int64)
    listed = spark.createDataFrame(
        [(i, row[0], n, t) for i, (row, n, t) in enumerate(zip(found, sizes, goal))],
        "_no int, _name string, _source_size bigint, _target double",
    )
    # At most MAX_SOURCES short rows.
    rows = sized.join(F.broadcast(listed), F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    spans, draws = materialise(_spans(rows), "mix-spans"), materialise(_draws(spark, blocks, wanted, shard_slots, seed), "mix-draws")
    sources = listed.select("_no", "_name")
    named = docs.select(*_named(F.col(doc_id), F.col(text), F.col(source)), F.col(text).cast("string").alias("_text"))
    dictionary = _dictionary(named)
    texts = _keyed(_squeezed(named, dictionary), sources)
    shards = materialise(_shards(texts, spans, draws, block_words, dictionary), "mix-shards", compression="zstd")
    return Mix(spans, draws, rows, shards, sources)


def _spans(rows: DataFrame) -> DataFrame:
    """(_no, _start, _end) of each row with words. Running sums in two levels, so that a source
    with most of the rows is summed in many tasks."""
    full = rows.where("_size > 0").withColumn("_chunk", F.pmod(F.xxhash64("_id", "_tie"), F.lit(CHUNKS)).cast("int"))
    before = Window.partitionBy("_no").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = full.groupBy("_no", "_chunk").agg(F.sum("_size").alias("_n"))
    offsets = chunks.select("_no", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_no", "_chunk").orderBy("_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = full.withColumn("_upto", F.sum("_size").over(within)).join(offsets, ["_no", "_chunk"])
    end = F.col("_offset") + F.col("_upto")
    return placed.withColumn("_start", end - F.col("_size")).withColumn("_end", end).drop("_chunk", "_upto", "_offset")


def _draws(spark, blocks: list[int], wanted: np.ndarray, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, _no, pass, _block): which block fills each slot."""
    shards = -(-int(wanted.sum()) // shard_slots)
    groups = min(GROUPS, -(-shards // SPAN))
    edges = [shards * g // groups for g in range(groups + 1)] if groups else [0]
    rng, left, plan = np.random.default_rng([seed, 0]), wanted.copy(), []
    for g, (a, b) in enumerate(zip(edges, edges[1:])):
        mine = draw(rng, (b - a) * shard_slots, left)
        plan.append((g, a, b, mine.tolist(), (wanted - left).tolist()))
        left = left - mine
    kind = "g int, first bigint, last bigint, counts array<bigint>, given array<bigint>"

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for g, first, last, counts, given in rows.itertuples(index=False):
                left, given = np.array(counts, np.int64), np.array(given, np.int64)
                rng = np.random.default_rng([seed, 1, g])
                for shard in range(first, last):
                    mine = draw(rng, shard_slots, left)
                    left = left - mine
                    number = np.repeat(np.arange(len(mine)), mine)
                    turn, block = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
                    at = 0
                    for no in np.flatnonzero(mine):
                        j = given[no] + np.arange(mine[no])
                        turn[at : at + len(j)] = j // blocks[no]
                        for t in np.unique(j // blocks[no]):
                            here = np.flatnonzero(j // blocks[no] == t)
                            block[at + here] = permuted(j[here] % blocks[no], blocks[no], hash_key(seed, int(no), int(t)))
                        at += len(j)
                    given = given + mine
                    slot = rng.permutation(len(number))
                    yield pd.DataFrame({"shard": shard, "slot": slot, "_no": number, "pass": turn, "_block": block})

    table = spark.createDataFrame(plan, kind).repartition(max(1, groups))
    return table.mapInPandas(fill, "shard bigint, slot int, _no int, pass int, _block bigint")


def hash_key(*parts: int) -> int:
    out = 0
    for part in parts:
        out = out << 40 | part
    return out


def pieces(spans: DataFrame, block_words: int) -> DataFrame:
    """Each row's part in each block: (_no, _block, _from, _upto) within the source's line of words."""
    first, last = F.floor(F.col("_start") / block_words), F.floor((F.col("_end") - 1) / block_words)
    cut = spans.withColumn("_block", F.explode(F.sequence(first, last)))
    return cut.withColumn("_from", F.greatest("_start", F.col("_block") * block_words)).withColumn(
        "_upto", F.least("_end", (F.col("_block") + 1) * block_words)
    )


KEY = ["_kind", "_key", "_tie"]  #: tells the rows of a mix apart: source and whether it has an id, id, hash of the text
ASKED = "shard bigint, slot int, pass int, _start bigint, a int, b int"


def _named(doc_id: Column, text: Column, source: Column) -> list[Column]:
    return [doc_id.cast("bigint").alias("_id"), F.xxhash64(text.cast("string")).alias("_tie"), source.cast("string").alias("_source")]


def _key() -> list[Column]:
    return [(F.col("_no") * 2 + F.col("_id").isNull().cast("int")).alias("_kind"), F.coalesce("_id", F.lit(0)).alias("_key"), F.col("_tie")]


def _keyed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """``docs`` with (_id, _tie, _source) under the ``KEY`` instead; equal rows once.

    The sources are at most ``MAX_SOURCES`` short rows.
    """
    rest = [c for c in docs.columns if c not in ("_id", "_tie", "_source")]
    found = docs.join(F.broadcast(sources), F.col("_source").eqNullSafe(F.col("_name"))).select(*_key(), *rest)
    turn = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0)))
    return found.withColumn("_turn", turn).where("_turn = 1").drop("_turn")


def _dictionary(docs: DataFrame) -> bytes:
    """Trained on the heads of a few texts, empty if they are too few."""
    heads = docs.select(F.substring("_text", 1, SAMPLE_CHARS).alias("t")).where("t <> ''").limit(SAMPLE_DOCS).collect()
    return tokens.train([row.t.encode() for row in heads], DICTIONARY_BYTES)


def _squeezed(docs: DataFrame, dictionary: bytes) -> DataFrame:
    """``docs`` with ``_text`` as a Zstandard frame."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.compressor(dictionary).compress
        for block in grouped(batches, "_text", BLOCK_BYTES):
            frames = pa.array([encode(text) for text in texts_of(block["_text"].combine_chunks())], pa.binary())
            yield from block.set_column(block.schema.get_field_index("_text"), "_text", frames).to_batches()

    kinds = ", ".join(f"{name} {'binary' if name == '_text' else kind}" for name, kind in docs.dtypes)
    return docs.mapInArrow(squeeze, kinds)


def _shards(texts: DataFrame, spans: DataFrame, draws: DataFrame, block_words: int, dictionary: bytes) -> DataFrame:
    """The rows of ``Mix.shards``; ``texts`` are frames, and so are words until their slot is whole. Slots meet blocks by index first, so that a text moves once to
    its parts and its words once to their shards. What moves beside texts and words are numbers;
    a part's block follows from its place."""
    names = [field.split()[0] for field in ASKED.split(", ")]
    cut_up = pieces(spans.select(*_key(), "_no", "_start", "_end"), block_words).select(
        *KEY, "_no", "_block", "_start",
        (F.col("_from") - F.col("_start")).cast("int").alias("a"), (F.col("_upto") - F.col("_start")).cast("int").alias("b"),
    )
    # The planner takes the draws for as small as the plan they are made from: never broadcast them.
    used = cut_up.join(draws.hint("merge"), ["_no", "_block"])
    asked = used.groupBy(*KEY).agg(F.collect_list(F.struct(*names)).alias("_asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = tokens.compressor(dictionary).compress, tokens.decompressor(dictionary).decompress
        for block in grouped(batches, "_text", BLOCK_BYTES):
            asked, said = block["_asked"].combine_chunks(), []
            part, count = asked.flatten(), asked.value_lengths()
            a, b = part.field("a").to_pylist(), part.field("b").to_pylist()
            at = 0
            for text, n in zip(texts_of(block["_text"].combine_chunks()), count.to_pylist()):
                w = words(decode(text))
                said += [encode(b" ".join(w[a[i] : b[i]])) for i in range(at, at + n)]
                at += n
            number = np.repeat(np.asarray(block["_kind"]) // 2, np.asarray(count)).astype(np.int32)
            columns = {name: part.field(name) for name in names} | {"_no": pa.array(number), "_said": pa.array(said, pa.binary())}
            yield from pa.table(columns).to_batches()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = tokens.decompressor(dictionary).decompress
        for batch in batches:
            place = batch.schema.get_field_index("words")
            frames, count = batch.column(place).flatten().to_pylist(), batch.column(place).value_lengths().to_pylist()
            said, size, first, at = [], 0, 0, 0
            for row, n in enumerate(count, 1):
                said.append(b" ".join(decode(frame) for frame in frames[at : at + n]).decode())
                size, at = size + len(said[-1]), at + n
                if size >= BLOCK_BYTES or row == len(count):
                    columns = batch.slice(first, row - first).columns
                    columns[place] = pa.array(said, pa.string())
                    yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
                    said, size, first = [], 0, row

    met = texts.join(asked.hint("merge"), KEY).select("_kind", "_text", "_asked")
    said = met.mapInArrow(cut, ASKED + ", _no int, _said binary")
    parts = F.sort_array(F.collect_list(F.struct("_start", "a", "b", "_said")))
    slots = said.repartition("shard").groupBy("shard", "slot", "_no", "pass").agg(parts.alias("_p"))
    first = F.col("_p")[0]
    framed = slots.select(
        "shard", "slot", "_no", "pass", F.floor((first["_start"] + first["a"]) / block_words).alias("_block"),
        F.col("_p._said").alias("words"),
        F.transform("_p", lambda p: F.struct(p["_start"].alias("_start"), p["a"].alias("a"), p["b"].alias("b"))).alias("_parts"),
    ).sortWithinPartitions("shard", "slot")
    kinds = ", ".join(f"{name} {'string' if name == 'words' else kind}" for name, kind in framed.dtypes)
    return framed.mapInArrow(whole, kinds)


def used_parts(mix: Mix) -> DataFrame:
    """(_no, pass, _start, a, b): the parts of rows that the shards hold, one per slot and row."""
    return mix.shards.select("_no", "pass", F.explode("_parts").alias("_p")).select("_no", "pass", "_p.*")


def taken(mix: Mix, block_words: int = 64) -> DataFrame:
    """(_id, _size, _source, _source_size, _target, _taken): words that the mix takes of each row.

    The shards tell; ``block_words`` is that of the plan.
    """
    figures = ["_id", "_size", "_source", "_source_size", "_target"]
    held = used_parts(mix).groupBy("_no", "_start").agg(F.sum(F.col("b") - F.col("a")).alias("_held"))
    full = mix.spans.join(held.hint("merge"), ["_no", "_start"], "left").select(*figures, F.coalesce("_held", F.lit(0).cast("bigint")).alias("_taken"))
    return full.unionByName(mix.rows.where("_size = 0").select(*figures, F.lit(0).cast("bigint").alias("_taken")))


def mixed_texts(
    docs: DataFrame, mix: Mix, block_words: int = 64, doc_id: str = "doc_id", text: str = "text",
    n_chars: str | None = "n_chars", source: str = "source",
) -> DataFrame:
    """The mix as documents: a row per document and pass with the words that the pass takes of it,
    the whole text unchanged where that is all. Columns are those of ``docs``.

    Which words those are is read from the shards. Runs of words that a pass leaves out are cut
    from the text; what stays keeps its line breaks.
    """
    held = used_parts(mix).groupBy("_no", "_start", "pass").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("_parts"))
    turns = mix.spans.join(held.hint("merge"), ["_no", "_start"])
    parts = turns.select(*_key(), "_size", "_parts").groupBy(*KEY).agg(F.first("_size").alias("_words"), F.collect_list("_parts").alias("_turns"))
    named = dict(zip(("_id", "_tie", "_source"), _named(F.col(doc_id), F.col(text), F.col(source))))
    met = _keyed(packed(docs, **named), mix.sources).join(parts, KEY).withColumn("_parts", F.explode("_turns"))
    whole = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + p["b"] - p["a"]) == F.col("_words")
    body = F.col("_given").getField(text)
    out = met.withColumn("_text", F.when(whole, body).otherwise(_cut(body, F.col("_parts"))))
    changed = {text: F.col("_text")}
    if n_chars in docs.columns:
        changed[n_chars] = F.char_length("_text").cast(docs.schema[n_chars].dataType)
    return out.select(*(changed.get(c, F.col("_given").getField(c)).alias(c) for c in docs.columns))


@F.pandas_udf(T.StringType())
def _cut(text: pd.Series, parts: pd.Series) -> pd.Series:
    """The words [a, b) of each part with the white space between them, parts joined by a blank."""
    import re

    word = re.compile(WORD)

    def one(body: str, runs) -> str:
        at = [m.span() for m in word.finditer(body)]
        merged: list[list[int]] = []
        for run in runs:
            if merged and merged[-1][1] == run["a"]:
                merged[-1][1] = run["b"]
            else:
                merged.append([run["a"], run["b"]])
        return " ".join(body[at[a][0] : at[b - 1][1]] for a, b in merged)

    return pd.Series([one(t, p) for t, p in zip(text, parts)])
