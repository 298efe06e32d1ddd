"""TF-IDF: term counts, vocabulary, weights.

Counts are taken inside each row. The vocabulary comes from one shuffle by term, combined
map-side. With a bounded vocabulary a text's vector is then made where the text lies, without
any shuffle; an unbounded one is joined by term.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelens.functions import text as tx
from queuelens.functions.lookup import join_lookup
from queuelens.functions.text import let
from queuelens.session import materialise


LISTED_TERMS = 50_000  # a longer vocabulary is joined


def term_counts(df: DataFrame, key: str, text: str, ngram_range=(1, 1), stop_words=None, keep_empty=False) -> DataFrame:
    """One row (key, term, tf) per different term of each text.

    ``keep_empty`` keeps texts without any term as one row with null term.
    """
    low, high = ngram_range
    words = tx.without(tx.tokens(tx.blank_if_null(F.col(text))), stop_words or [])
    listed = df.select(key, tx.counts(tx.ngrams(words, low, high)).alias("terms"))
    # A plain explode makes the optimizer add a filter that counts the terms again.
    rows = listed.select(key, F.explode_outer("terms").alias("t"))
    rows = rows.select(key, F.col("t.value").alias("term"), F.col("t.n").alias("tf"))
    return rows if keep_empty else rows.filter(F.col("term").isNotNull())


def corpus_frequencies(counts: DataFrame) -> DataFrame:
    """Total count ``tf`` and document count ``df`` of each term."""
    return counts.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


def term_lists(df: DataFrame, key: str, text: str, ngram_range=(1, 1), stop_words=None) -> DataFrame:
    """(key, terms): the terms of each text in order, repeats included."""
    words = tx.without(tx.tokens(tx.blank_if_null(F.col(text))), stop_words or [])
    return df.select(key, tx.ngrams(words, *ngram_range).alias("terms"))


def listed_frequencies(lists: DataFrame) -> DataFrame:
    """:func:`corpus_frequencies` of term lists: a term counts for ``df`` where a text's sorted list has it first."""

    def marked(s: Column) -> Column:
        return F.transform(s, lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get(s, i - 1) != t)).alias("first")))

    rows = lists.select(F.explode_outer(let(F.sort_array("terms"), marked)).alias("t")).select("t.*").filter("term IS NOT NULL")
    return rows.groupBy("term").agg(F.count("*").alias("tf"), F.count_if("first").alias("df"))


def vocabulary(frequencies: DataFrame, max_features: int | None) -> DataFrame:
    """The ``max_features`` most frequent terms; ties go to the smaller term."""
    if max_features is None:
        return frequencies
    return frequencies.orderBy(F.desc("tf"), "term").limit(max_features)


def with_idf(vocab: DataFrame, documents: DataFrame) -> DataFrame:
    """Add the smoothed inverse document frequency over all rows of ``documents``."""
    n = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return vocab.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


def fit(df: DataFrame, key: str, text: str, max_features=None, ngram_range=(1, 1), stop_words=None) -> DataFrame:
    """Vocabulary (term, tf, df, idf) of a corpus."""
    lists = term_lists(df, key, text, ngram_range, stop_words)
    return with_idf(vocabulary(listed_frequencies(lists), max_features), df)


def weighted(entries: Column, sublinear: bool) -> Column:
    """Entries (term, tf, idf) as (term, weight), L2-normalised over the text."""

    def weight(e: Column) -> Column:
        return (1 + F.log(e["tf"]) if sublinear else e["tf"]) * e["idf"]

    raw = F.transform(entries, lambda e: F.struct(e["idx"].alias("idx"), weight(e).alias("weight")))
    return let(
        raw,
        lambda r: let(
            F.sqrt(F.aggregate(r, F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"])),
            lambda norm: F.transform(r, lambda e: F.struct(e["idx"].alias("idx"), (e["weight"] / norm).alias("weight"))),
        ),
    )


def vectors_in_place(lists: DataFrame, terms: list[str], idf: list[float], key: str, sublinear: bool = False) -> DataFrame:
    """(key, entries): (idx, weight) of each text's known terms, by place in ``terms``. No shuffle."""
    model = CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="_counts")
    counted = model.transform(lists).select(key, F.unwrap_udt("_counts").alias("c"))
    table = F.lit(idf)
    known = F.zip_with(
        "c.indices", "c.values", lambda i, n: F.struct(i.alias("idx"), n.alias("tf"), F.get(table, i).alias("idf"))
    )
    return counted.select(key, weighted(known, sublinear).alias("entries"))


def text_vectors(counts: DataFrame, vocab: DataFrame, key: str, sublinear: bool = False, vocab_rows: int = 50_000) -> DataFrame:
    """One row (key, entries) per text, where entries hold the vocabulary columns and
    the L2-normalised ``weight``. Texts enter with at least one row in ``counts``."""
    extra = [c for c in vocab.columns if c not in ("tf", "df", "idf")]
    known = join_lookup(counts, vocab.select(*extra, "idf"), "term", "left", vocab_rows)
    tf = F.col("tf").cast("double")
    weight = (1 + F.log(tf) if sublinear else tf) * F.col("idf")
    entry = F.when(F.col("idf").isNotNull(), F.struct(*extra, weight.alias("weight")))
    grouped = known.groupBy(key).agg(F.collect_list(entry).alias("raw"))
    squares = F.aggregate("raw", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"])
    entries = let(
        F.sqrt(squares),
        lambda norm: F.transform("raw", lambda e: e.withField("weight", e["weight"] / norm)),
    )
    return grouped.select(key, entries.alias("entries"))


def weight_lists(df: DataFrame, vocab: DataFrame, key: str, text: str, ngram_range=(1, 1), stop_words=None, sublinear=False) -> DataFrame:
    """(key, entries): the (term, weight) of each text under a fitted vocabulary."""
    known = vocab.select("term", "idf").limit(LISTED_TERMS + 1).collect()
    if 0 < len(known) <= LISTED_TERMS:
        known.sort()
        terms = [r.term for r in known]
        lists = term_lists(df, key, text, ngram_range, stop_words)
        rows = vectors_in_place(lists, terms, [r.idf for r in known], key, sublinear)
        named = F.transform("entries", lambda e: F.struct(F.get(F.lit(terms), e["idx"]).alias("term"), e["weight"].alias("weight")))
        return rows.select(key, named.alias("entries"))
    # Rows are placed by key while they are still whole texts; all later steps stay in place.
    placed = df.select(key, text).repartition(key)
    counts = term_counts(placed, key, text, ngram_range, stop_words)
    return text_vectors(counts, vocab.select("term", "idf"), key, sublinear)


def weight_rows(lists: DataFrame, *columns: str) -> DataFrame:
    """Long form (columns, term, weight) of :func:`weight_lists`."""
    rows = lists.select(*columns, F.explode_outer("entries").alias("e")).filter("e.term IS NOT NULL")
    return rows.select(*columns, "e.term", "e.weight")


def transform(df: DataFrame, vocab: DataFrame, key: str, text: str, ngram_range=(1, 1), stop_words=None, sublinear=False) -> DataFrame:
    """Long form (key, term, weight) of the texts under a fitted vocabulary."""
    return weight_rows(weight_lists(df, vocab, key, text, ngram_range, stop_words, sublinear), key)


def fit_lists(df: DataFrame, key: str, text: str, max_features=None, ngram_range=(1, 1), stop_words=None, sublinear=False) -> DataFrame:
    """Fit on ``df`` and return its :func:`weight_lists`."""
    # Stored, so that measuring and broadcasting it does not read the texts again.
    vocab = materialise(fit(df, key, text, max_features, ngram_range, stop_words), "vocabulary")
    return weight_lists(df, vocab, key, text, ngram_range, stop_words, sublinear)


def fit_transform(df: DataFrame, key: str, text: str, max_features=None, ngram_range=(1, 1), stop_words=None, sublinear=False) -> DataFrame:
    """Fit on ``df`` and return its weights (key, term, weight)."""
    return weight_rows(fit_lists(df, key, text, max_features, ngram_range, stop_words, sublinear), key)
