"""A corpus pipeline: documents in, files of token ids out.

Each stage works on all that the one before kept. ``run`` writes a stage's rows as Parquet in
the shared folder and reads them again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm import leaks, line_field, mixing, simhash, tokens
from queuelens.llm.common import fresh, table
from queuelens.llm.queries import BLOCK_WORDS, END_ID, tokenizer_path
from queuelens.session import materialise, scratch

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MAX_ARROW_BYTES = 4 << 20  #: 10,000 whole texts take tens of MB, in the JVM and again in Python


def small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` in a session that hands Python at most ``MAX_ARROW_BYTES`` at a time.

    Stages are lazy, so the setting stays; where a session has one of its own, that holds. Rows are
    the same with any.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(ARROW_BYTES, None) is None:
            spark.conf.set(ARROW_BYTES, str(MAX_ARROW_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the line field takes for good ones."""
    field = line_field.learn(docs, table(spark, sf_dir, "labels"))
    column = fresh("_score", docs)
    scored = line_field.score(docs, field, column=column)
    return scored.where(F.col(column) >= line_field.THRESHOLD).select(*docs.columns)


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that with the least id."""
    return simhash.keep_one(docs)


@small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    found = leaks.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size(fresh("_items", docs)) == 0).select(*docs.columns)


@small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row per document and pass, with the words that the pass takes."""
    plan = mixing.plan_mix(docs, block_words=BLOCK_WORDS)
    return mixing.mixed_texts(docs, plan, BLOCK_WORDS)


@small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes ids in files and returns each document's row, read from the files."""
    return tokens.read_ids(spark, tokens.write_ids(docs, tokenizer_path(), END_ID))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("token ids", token_ids),
]

#: None: fitted weights, fingerprints, edit distances, draws and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as keep_last:
        for name, stage in STAGES:
            with scratch(spark) as keep:  # what the stage wrote for itself goes
                docs = keep(materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-")))
        return keep_last(docs)


QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
