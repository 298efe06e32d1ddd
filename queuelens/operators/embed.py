"""Text to dense vector, by one of several providers.

``hashing`` stays in the JVM and reads each row once, without a shuffle.
``precomputed`` joins a vector table. ``word2vec`` fits MLlib's model.
``udf`` runs a user's model over Arrow batches, behind the vector store.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelens.config import key_column
from queuelens.functions import text as tx
from queuelens.functions import vectors as vx
from queuelens.functions.lookup import join_lookup
from queuelens.session import materialise
from queuelens.sources.store import embed_with_store, text_key

UNKNOWN = "Unknown"


def hashing_vector(text: Column, dim: int) -> Column:
    """Signed token counts: the first 8 hex digits of a token's MD5 pick the dimension,
    the next digit the sign. The entries are whole numbers, so sums are exact."""

    def code(token: Column) -> Column:
        return tx.let(
            F.md5(token.cast("binary")),
            lambda h: (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % dim) * 2
            + F.when(F.substring(h, 9, 1) < "8", 1).otherwise(0),
        )

    def dense(table: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint")),
            lambda i: (
                F.coalesce(F.try_element_at(table, i * 2 + 1), F.lit(0))
                - F.coalesce(F.try_element_at(table, i * 2), F.lit(0))
            ).cast("double"),
        )

    codes = F.transform(tx.tokens(tx.blank_if_null(text)), code)
    return tx.let(F.map_from_entries(tx.counts(codes)), dense)


class HashingEmbedder:
    """Built-in expressions only."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def add(self, df: DataFrame, text: str, name: str) -> DataFrame:
        return df.withColumn(name, hashing_vector(F.col(text), self.dim))


class PrecomputedEmbedder:
    """Vectors from a table (key, vector); rows without one get zeros."""

    def __init__(self, table: DataFrame, key: str, vector: str, dim: int):
        self.table, self.key, self.dim = table.select(key, vx.as_doubles(F.col(vector)).alias("_vec")), key, dim

    def add(self, df: DataFrame, text: str, name: str) -> DataFrame:
        found = join_lookup(df, self.table, self.key)
        return found.withColumn(name, F.coalesce("_vec", vx.zeros(self.dim))).drop("_vec")


class Word2VecEmbedder:
    """Mean of word vectors that MLlib fits on the texts themselves."""

    def __init__(self, dim: int = 64, min_count: int = 5, seed: int = 42, rows_per_task: int = 10_000):
        self.dim, self.min_count, self.seed, self.rows_per_task = dim, min_count, seed, rows_per_task

    def add(self, df: DataFrame, text: str, name: str) -> DataFrame:
        words = df.withColumn("_words", tx.tokens(tx.blank_if_null(F.col(text))))
        # Each part fits its share, then they are averaged. Every part sends all words it met, twice: no more parts than cores.
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = max(1, min(math.ceil(words.count() / self.rows_per_task), cores))
        model = Word2Vec(
            vectorSize=self.dim, minCount=self.min_count, seed=self.seed, numPartitions=parts,
            inputCol="_words", outputCol="_vec",
        ).fit(words)
        return model.transform(words).withColumn(name, vector_to_array("_vec")).drop("_words", "_vec")


class FunctionEmbedder:
    """A user's ``load() -> (list[str] -> ndarray)``; the model is loaded once per task."""

    def __init__(self, load: Callable[[], Callable[[list], np.ndarray]], dim: int, model_id: str, store: str, batch_size: int = 128):
        if not re.fullmatch(r"[\w.-]+", model_id):
            raise ValueError("model_id may hold letters, digits, '_', '.' and '-'")
        self.load, self.dim, self.model_id, self.store, self.batch_size = load, dim, model_id, store, batch_size

    def _embed(self, texts: DataFrame) -> DataFrame:
        load, size = self.load, self.batch_size

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = None
            for frame in frames:
                for start in range(0, len(frame), size):
                    model = model or load()
                    part = frame.iloc[start : start + size]
                    vectors = np.asarray(model(part["text"].tolist()), dtype=float)
                    yield pd.DataFrame({"text_key": part["text_key"].to_numpy(), "vector": list(vectors)})

        return texts.mapInPandas(run, "text_key string, vector array<double>")

    def _in_place(self, df: DataFrame, text: str, name: str) -> DataFrame:
        """Embed every row's text where it is, as a stream needs it."""
        load, size = self.load, self.batch_size

        @F.pandas_udf("array<double>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                texts, out = ["" if t is None else t for t in batch.tolist()], []
                for start in range(0, len(texts), size):
                    out += [[float(x) for x in v] for v in np.asarray(model(texts[start : start + size]), dtype=float)]
                yield pd.Series(out, dtype=object)

        return df.withColumn(name, run(F.col(text)))

    def add(self, df: DataFrame, text: str, name: str) -> DataFrame:
        if df.isStreaming:
            return self._in_place(df, text, name)
        known = embed_with_store(df, text, self.store, self.model_id, self._embed)
        keyed = df.withColumn("_text_key", text_key(F.col(text)))
        vectors = known.select(F.col("text_key").alias("_text_key"), F.col("vector").alias(name))
        return keyed.join(vectors, "_text_key", "left").drop("_text_key")


def embedder_for(config: dict, **parts):
    """The provider that ``embeddings.provider`` names."""
    cfg = config["embeddings"]
    provider, dim = cfg.get("provider", "hashing"), cfg.get("dim", 64)
    if provider == "hashing":
        return HashingEmbedder(dim)
    if provider == "word2vec":
        return Word2VecEmbedder(dim)
    if provider == "precomputed":
        return PrecomputedEmbedder(parts["table"], parts.get("key", key_column(config)), parts.get("vector", "vector"), dim)
    if provider == "udf":
        return FunctionEmbedder(parts["load"], dim, cfg["model"], cfg["cache_path"], cfg.get("batch_size", 128))
    raise ValueError(f"Unknown provider: '{provider}'. Use 'hashing', 'precomputed', 'word2vec' or 'udf'.")


def generate_embeddings(df: DataFrame, config: dict, embedder=None, text: str = "text", name: str = "semantic") -> DataFrame:
    """Add the semantic vector of ``text``."""
    return (embedder or embedder_for(config)).add(df, text, name)


def distinct_tags(df: DataFrame, column: str) -> DataFrame:
    """The different real tags."""
    return df.select(F.coalesce(column, F.lit(UNKNOWN)).alias("tag")).distinct().filter(F.col("tag") != UNKNOWN)


def enrich_with_tag_embeddings(df: DataFrame, config: dict, embedder=None, name: str = "semantic") -> DataFrame:
    """Append the weighted vector of the ticket's tag; zeros where it has no real tag.

    Each different tag is embedded once and looked up.
    """
    cfg = config["embeddings"]["tag_enrichment"]
    column, weight = cfg["column"], cfg.get("weight", 1.0)
    embedder = embedder or embedder_for(config)
    lookup = embedder.add(distinct_tags(df, column), "tag", "_tag_vec").select(F.col("tag").alias(column), "_tag_vec")
    found = join_lookup(df, materialise(lookup, "tag-vectors"), column)
    scaled = F.coalesce(vx.scaled(F.col("_tag_vec"), weight), vx.zeros(embedder.dim))
    return found.withColumn(name, F.concat(name, scaled)).select(*df.columns)
