"""Text sources: files as lines, documents as lines, globbed log shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.arrays import explode_rows


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the text files at ``path`` (file, folder or glob); gzip by suffix."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def scan_text_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Lines of every file that matches ``pattern`` plus the file each came from."""
    return (spark.read.text(pattern)
            .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path")))


def document_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): a text table cut into its lines, whole texts kept."""
    lines = explode_rows(documents, F.split("text", "\n", -1), ["doc_id"], "line", "line_no")
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line")
