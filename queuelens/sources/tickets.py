"""Reading a ticket table and checking its columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.config import key_column
from queuelens.functions.words import NA_TOKENS
from queuelens.operators.ranking import with_position


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a freshly read table out to all cores if its files are fewer.

    Text work is heavy per row. A table of many files is left as it lies.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def _missing_path(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or str(error))


def read_csv(spark: SparkSession, path: str, na_values=(), schema=None) -> DataFrame:
    """CSV with a header and quoted texts that may span lines; all columns are text.

    Missing-value texts become null. Quoted line breaks keep a file in one task, so
    large exports should come as many files.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(path)
    missing = sorted(set(NA_TOKENS) | set(na_values))
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(missing), F.col(f"`{c}`")) for c in texts})


def required_columns(config: dict) -> list[str]:
    data = config["data"]
    return list(data["text_columns"]) + list(data["metadata_columns"].values())


def check_columns(df: DataFrame, config: dict) -> DataFrame:
    """Raise if a text or metadata column is absent."""
    absent = set(required_columns(config)).difference(df.columns)
    if absent:
        raise ValueError(f"Missing expected columns: {sorted(absent)}")
    return df


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Number the rows of a table that has no key by the order of their hashes.

    The numbers depend on the rows alone, not on files or partitions; equal rows can be
    exchanged for each other anyway. The table is written, so the numbers stay.
    """
    if key in df.columns:
        return df
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    hashed = df.withColumns({"_row_hash_a": F.xxhash64(whole), "_row_hash_b": F.xxhash64(F.lit(7), whole)})
    return with_position(hashed, ["_row_hash_a", "_row_hash_b"], key).drop("_row_hash_a", "_row_hash_b")


def load_data(spark: SparkSession, path: str | None, config: dict) -> DataFrame:
    """The ticket table of ``config``: a CSV export or a Parquet snapshot.

    Raises FileNotFoundError for a missing path and ValueError for missing columns.
    """
    path = path or config["data"]["path"]
    source = config["data"].get("source", "csv")
    try:
        if source == "csv":
            df = read_csv(spark, path, config["data"].get("na_values", ()))
        elif source == "parquet":
            df = spark.read.parquet(path)
        else:
            raise ValueError(f"Unknown source: '{source}'. Use 'csv' or 'parquet'.")
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(f"{path} not found: name an existing file or folder as data.path") from error
        raise
    return spread(with_key(check_columns(df, config), key_column(config)))
