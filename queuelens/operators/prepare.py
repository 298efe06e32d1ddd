"""Text preparation of a ticket table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.functions import text as tx


def preprocess(df: DataFrame, config: dict) -> DataFrame:
    """Add ``text``: both text columns combined and cleaned. Other columns are kept."""
    first, second = config["data"]["text_columns"]
    separator = config["preprocessing"]["combine_separator"]
    return df.withColumn("text", tx.cleaned(tx.combined(F.col(first), F.col(second), separator)))


def with_raw_text(df: DataFrame, config: dict, name: str = "raw_text") -> DataFrame:
    """Add the uncleaned combined text that the label classifier reads."""
    first, second = config["data"]["text_columns"]
    return df.withColumn(name, tx.combined(F.col(first), F.col(second)))


def with_lengths(df: DataFrame, config: dict) -> DataFrame:
    """Add word counts ``subject_len``, ``body_len`` and their sum ``combined_len``."""
    first, second = config["data"]["text_columns"]
    return df.withColumns(
        {"subject_len": tx.word_count(F.col(first)), "body_len": tx.word_count(F.col(second))}
    ).withColumn("combined_len", F.col("subject_len") + F.col("body_len"))
