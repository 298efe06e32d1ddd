"""A ticket table derived from the ``documents`` and ``labels`` tables.

Every document is a ticket. Nulls, classes and skew follow from columns of the data.
The same rules are given once for Spark and once as SQL text for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.sources.tickets import spread


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{folder}/documents.parquet"))
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    joined = docs.join(marks, "doc_id", "left")
    size = F.col("n_chars")
    quality, toxic = F.col("quality"), F.col("toxic")
    labelled = quality.isNotNull()
    return joined.select(
        F.col("doc_id").alias("ticket_id"),
        F.when(F.col("lang") != "es", F.substring_index("text", ".", 1)).alias("subject"),
        F.col("text").alias("body"),
        F.when((quality == 1) & (toxic == 0), "Incident")
        .when((quality == 0) & (toxic == 0), "Request")
        .when((quality == 1) & (toxic == 1), "Problem")
        .when((quality == 0) & (toxic == 1), "Change")
        .alias("type"),
        F.col("source").alias("queue"),
        F.when(size < 500, "very_low")
        .when(size < 1000, "low")
        .when(size < 2000, "medium")
        .when(size < 4000, "high")
        .when(size < 8000, "critical")
        .otherwise("urgent")
        .alias("priority"),
        F.col("lang").alias("language"),
        F.when(labelled, F.concat(F.lit("from "), F.col("source"))).alias("tag_1"),
        F.when(labelled & (quality == 0), F.concat(F.lit("poor "), F.col("lang"))).alias("tag_2"),
        F.when(labelled & (toxic == 1), F.lit("toxic")).alias("tag_3"),
    )


TICKETS_SQL = """
SELECT d.doc_id AS ticket_id,
       CASE WHEN d.lang <> 'es' THEN split_part(d.text, '.', 1) END AS subject,
       d.text AS body,
       CASE WHEN quality = 1 AND toxic = 0 THEN 'Incident' WHEN quality = 0 AND toxic = 0 THEN 'Request'
            WHEN quality = 1 AND toxic = 1 THEN 'Problem' WHEN quality = 0 AND toxic = 1 THEN 'Change' END AS type,
       d.source AS queue,
       CASE WHEN n_chars < 500 THEN 'very_low' WHEN n_chars < 1000 THEN 'low' WHEN n_chars < 2000 THEN 'medium'
            WHEN n_chars < 4000 THEN 'high' WHEN n_chars < 8000 THEN 'critical' ELSE 'urgent' END AS priority,
       d.lang AS language,
       CASE WHEN l.doc_id IS NOT NULL THEN 'from ' || d.source END AS tag_1,
       CASE WHEN l.doc_id IS NOT NULL AND quality = 0 THEN 'poor ' || d.lang END AS tag_2,
       CASE WHEN l.doc_id IS NOT NULL AND toxic = 1 THEN 'toxic' END AS tag_3
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def given_labels(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed clustering (ticket_id, cluster) by document source; ``src0`` is noise."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return docs.select(F.col("doc_id").alias("ticket_id"), (number - 1).alias("cluster"))


GIVEN_LABELS_SQL = """
SELECT doc_id AS ticket_id, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) - 1 AS cluster FROM documents
"""
