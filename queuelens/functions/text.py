"""Text expressions: cleaning, tokens, n-grams, counts. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}_]{2,}"


def blank_if_null(col: Column) -> Column:
    """Text of ``col``, empty where it is null."""
    return F.coalesce(col.cast("string"), F.lit(""))


def combined(first: Column, second: Column, separator: str = " ") -> Column:
    """Both texts with ``separator`` between them, also where one is null."""
    return F.concat(blank_if_null(first), F.lit(separator), blank_if_null(second))


def cleaned(text: Column) -> Column:
    """Lower case, only ``a-z0-9`` and single blanks: any run of other characters,
    white space among them, becomes one blank in a single pass."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def word_count(text: Column) -> Column:
    """Number of pieces between white space; 0 for null and empty text."""
    pieces = F.split(blank_if_null(text), r"(?U)\s+")
    return F.size(F.filter(pieces, lambda p: p != ""))


def tokens(text: Column) -> Column:
    """Lower-case words of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def without(words: Column, stop_words: list[str]) -> Column:
    """``words`` less the stop words (a short list the caller gives)."""
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(list(stop_words)))


def ngrams(words: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` words, joined by a blank."""

    def runs(ws: Column, n: int) -> Column:
        if n == 1:
            return ws
        # Run i of n words is run i of n-1 words and word i+n-1: two lists side by side, no list per run.
        full = F.greatest(F.size(ws) - (n - 1), F.lit(0))
        return F.zip_with(F.slice(runs(ws, n - 1), 1, full), F.slice(ws, n, full), lambda a, b: F.concat(a, F.lit(" "), b))

    if low == high == 1:
        return words
    return let(words, lambda ws: F.concat(*[runs(ws, n) for n in range(low, high + 1)]))


def counts(items: Column) -> Column:
    """Array of (value, n) per different item: sort, then measure the runs.

    One sort per row takes the place of an explode, a shuffle and a group-by.
    """

    def measure(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda b: F.transform(
                b,
                lambda start, j: F.struct(
                    F.get(s, start).alias("value"),
                    (F.coalesce(F.get(b, j + 1), F.size(s)) - start).cast("bigint").alias("n"),
                ),
            ),
        )

    return let(F.sort_array(items), measure)
