"""Line dedup over levelled sorted runs of line hashes.

Lines arrive in batches of documents. A batch is reduced to one entry per line key and
merge-anti-joined with the runs already there. Keys that no run holds start in the batch's own
run, so a key lies in one run; keys already held add to it by an increment. ``fan_out`` runs of
one level are compacted into one of the next, so a key is rewritten once per level and a batch
meets few runs. The verdict is read from the runs with their increments.

A key is the line without ASCII white space at both ends and with A-Z lower-cased; it is
stored as two 64-bit hashes with different seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.functions.text import let
from queuelens.llm.common import BLANKS, ascii_lower, fresh, packed
from queuelens.session import materialise, new_table_path, remove, remove_table

KEY = ["_h1", "_h2"]
BATCH_LINES = 20_000_000  #: lines of a batch, about


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def key_hash(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("second"), key).alias("_h2")]


class LineRuns:
    """Runs of (key, number of documents, largest document), each key in the run it started in, and
    runs of increments in the same form for keys met again later, both by level.

    A run is a table in the shared folder, sorted by key within its files.
    The lists of runs are the only state on the driver.
    """

    def __init__(self, spark: SparkSession, fan_out: int = 4):
        self.spark, self.fan_out = spark, fan_out
        self.levels: list[list[str]] = []
        self.increments: list[list[str]] = []
        self._old: list[str] = []  # runs that went into a compaction

    def add(self, entries: DataFrame) -> DataFrame:
        """Add a batch of (_h1, _h2, _docs, _last), one row per key; returns it as written, where
        ``_new`` marks the keys that no earlier batch held. It can be read until the next call."""
        self._forget()
        known = self._read(self.levels)
        if known is None:
            path = self._write(entries)
            added = self.spark.read.parquet(path).withColumn("_new", F.lit(True))
        else:
            own, keys = materialise(entries, "line-batch"), known.select(*KEY)
            path = self._write(own.join(keys, KEY, "left_anti"))
            again = self._write(own.join(keys, KEY, "left_semi"))
            remove_table(own)
            marked = [self.spark.read.parquet(p).withColumn("_new", F.lit(new)) for p, new in ((path, True), (again, False))]
            added = marked[0].unionByName(marked[1])
            self._place(self.increments, again, 0)
        self._place(self.levels, path, 0)
        return added

    def totals(self) -> DataFrame:
        """One entry per key: what its run holds and its increments."""
        held, more = self._read(self.levels), self._read(self.increments)
        if more is None:
            return held
        added = _merged(more).withColumnsRenamed({"_docs": "_more", "_last": "_later"})
        return held.join(added, KEY, "left").select(
            *KEY, (F.col("_docs") + F.coalesce("_more", F.lit(0))).alias("_docs"), F.greatest("_last", "_later").alias("_last")
        )

    def close(self) -> None:
        for path in [path for levels in (self.levels, self.increments) for level in levels for path in level]:
            remove(self.spark, path)
        self.levels, self.increments = [], []
        self._forget()

    def _read(self, levels: list[list[str]]) -> DataFrame | None:
        paths = [path for level in levels for path in level]
        return self.spark.read.parquet(*paths) if paths else None

    def _forget(self) -> None:
        for path in self._old:
            remove(self.spark, path)
        self._old = []

    def _place(self, levels: list[list[str]], path: str, depth: int) -> None:
        while len(levels) <= depth:
            levels.append([])
        levels[depth].append(path)
        if len(levels[depth]) >= self.fan_out:
            old, levels[depth] = levels[depth], []
            merged = self._write(_merged(self.spark.read.parquet(*old)))
            self._old += old
            self._place(levels, merged, depth + 1)

    def _write(self, entries: DataFrame) -> str:
        path = new_table_path(self.spark, "line-run")
        entries.sortWithinPartitions(*KEY).write.parquet(path)
        return path


def _merged(entries: DataFrame) -> DataFrame:
    return entries.groupBy(*KEY).agg(F.sum("_docs").alias("_docs"), F.max("_last").alias("_last"))


def keyed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(_id, _tie, _at, _h1, _h2): every line of at least ``min_chars`` code points of key, by its
    row (id and hash of the text) and its place in it."""
    lines = docs.select(
        F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_tie"),
        F.posexplode_outer(F.transform(lines_of(F.col(text)), line_key)).alias("_at", "_key"),
    ).where(F.char_length("_key") >= min_chars)
    return lines.select("_id", "_tie", "_at", *key_hash(F.col("_key")))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int | None = None,
    fan_out: int = 2,
) -> DataFrame:
    """Drop lines whose key is in at least ``min_docs`` documents, but in the largest that holds it.

    Returns ``docs`` with ``text`` replaced by the lines that stay, and ``_n_lines`` and
    ``_n_dropped``; where ``docs`` has a column of such a name, the figure's gets underscores in
    front until it is free. Rows that share a ``doc_id`` are one document. A null id counts as a
    document of its own and is never the largest. Null and empty texts are one empty line. A text
    that loses all lines is empty. Batches (one per ``BATCH_LINES`` lines, three at least, unless
    given) are dealt by a hash of the id, so every row of a document is in one batch and the
    counts of batches add up. The work on a text is linear in its lines.
    """
    spark = docs.sparkSession
    keyed = materialise(keyed_lines(docs, doc_id, text, min_chars), "line-keys")
    if batches is None:
        batches = max(3, -(-keyed.count() // BATCH_LINES))
    runs = LineRuns(spark, fan_out)
    for batch in range(batches):
        part = keyed.where(F.pmod(F.xxhash64("_id"), F.lit(batches)) == batch).select("_id", *KEY).distinct()
        runs.add(part.groupBy(*KEY).agg(F.count("*").alias("_docs"), F.max("_id").alias("_last")))
    common = materialise(runs.totals().where(F.col("_docs") >= min_docs).select(*KEY, "_last"), "line-common")
    runs.close()
    lost = (
        keyed.join(common, KEY)
        .where(~F.col("_id").eqNullSafe(F.col("_last")))
        .groupBy("_id", "_tie")
        .agg(F.collect_set("_at").alias("_lost"))
    )
    given = packed(docs, _key=F.col(doc_id), _hash=F.xxhash64(F.col(text)))
    joined = given.join(lost, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")), "left")

    def without(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_lost"))
        return F.transform(places, lambda i: lines[i])

    whole = F.col("_given").getField(text)
    kept = F.when(F.col("_lost").isNull(), F.coalesce(whole.cast("string"), F.lit(""))).otherwise(
        F.array_join(let(lines_of(whole), without), "\n")
    )
    columns = [kept.alias(c) if c == text else F.col("_given").getField(c).alias(c) for c in docs.columns]
    return joined.select(
        *columns,
        F.size(lines_of(whole)).cast("bigint").alias(fresh("_n_lines", docs)),
        F.when(F.col("_lost").isNull(), 0).otherwise(F.size("_lost")).cast("bigint").alias(fresh("_n_dropped", docs)),
    )
