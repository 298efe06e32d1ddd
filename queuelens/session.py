"""Session settings and the shared folder for materialised steps."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# AQE re-plans joins from measured sizes and splits skewed join partitions. No fixed
# partition count is set: the cluster's own setting holds, and AQE coalesces.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}  # local sessions without a configured folder


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("queuelens")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read: ``spark.checkpoint.dir``, or the one set on the context."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if context.applicationId in _local_folders:
        return _local_folders[context.applicationId]
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="queuelens-"))


def new_table_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []  # tables of the open scopes, the innermost last


def materialise(df: DataFrame, name: str, schema: T.StructType | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of iterative work, survives the loss of executors, and gives the
    planner true sizes. ``schema`` re-reads the files under another but equal layout.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    if _scratch:
        _scratch[-1].append(path)
    with tidied(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(schema or df.schema).parquet(path)


@contextmanager
def tidied(spark: SparkSession):
    """Shuffle files of what is run inside go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


@contextmanager
def scratch(spark: SparkSession):
    """Delete at its end the tables that ``materialise`` wrote inside, but those given to ``keep``.

    A kept table belongs to the scope around, if there is one. Only results that need no
    deleted table may leave: materialise them first.
    """
    mine: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        for folder in table_folders(df):
            for path in [p for p in mine if p.rsplit("/", 1)[1] == folder.rsplit("/", 1)[1]]:
                mine.remove(path)
                place = next(i for i, scope in enumerate(_scratch) if scope is mine)
                if place:
                    _scratch[place - 1].append(path)
        return df

    _scratch.append(mine)
    try:
        yield keep
    finally:
        del _scratch[next(i for i, scope in enumerate(_scratch) if scope is mine)]
        for path in mine:
            remove(spark, path)


def table_folders(df: DataFrame) -> set[str]:
    """The folders that a frame's files lie in."""
    return {path.rsplit("/", 1)[0] for path in df.inputFiles()}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table written by this session, wherever its file system is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_table(df: DataFrame) -> None:
    """Delete the files that a table made by ``materialise`` lies in."""
    for folder in table_folders(df):
        remove(df.sparkSession, folder)
