"""Delimited file readers and the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from quillspark.session import scratch_path

BLOCKS_SCHEMA = StructType([StructField("network", StringType()),
                            StructField("geoname_id", IntegerType())])
LOCATIONS_SCHEMA = StructType([StructField("geoname_id", IntegerType()),
                               StructField("locale_code", StringType()),
                               StructField("continent_code", StringType()),
                               StructField("continent_name", StringType()),
                               StructField("country_iso_code", StringType()),
                               StructField("country_name", StringType())])
ARTICLES_SCHEMA = StructType([StructField("id", LongType()), StructField("title", StringType()),
                              StructField("ts", TimestampNTZType()),
                              StructField("body", StringType())])


def scan_csv_dim(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row and quoted fields, read with an explicit schema."""
    return (spark.read.schema(schema).option("header", "true").option("quote", '"')
            .option("escape", '"').option("mode", "PERMISSIVE").csv(path))


def scan_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Tab-separated rows, no quoting, explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("quote", '"') \
        .option("escape", '"').csv(path)


def sink_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated part files replacing any older result at ``path``."""
    df.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)


def sink_single_file(df: DataFrame, path: str, order_by: list[str]) -> None:
    """One ordered file at ``path``, whatever the size of the result.

    The result is sorted and written as part files in parallel; their bytes, in name order, are
    then streamed into the one file through the Hadoop file system, so no task holds the whole.
    """
    spark = df.sparkSession
    parts = scratch_path(spark, "single-file-parts")
    df.orderBy(*order_by).write.option("sep", "\t").option("quote", "").csv(parts)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs, to = source.getFileSystem(conf), target.getFileSystem(conf)
    to.delete(target, True)
    out = to.create(jvm.org.apache.hadoop.fs.Path(target, "part-00000.csv"))
    try:
        for name in sorted(f.getPath().getName() for f in fs.listStatus(source)):
            if name.startswith("part-"):
                part = fs.open(jvm.org.apache.hadoop.fs.Path(source, name))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                part.close()
    finally:
        out.close()
    fs.delete(source, True)


def write_daily_text(lines: DataFrame, path: str, gzip_days: tuple[str, ...] = (), split: str | None = None) -> None:
    """Lines (``day``, ``line``) as text files in folders ``plain/day=...`` and ``gzip/day=...``.

    ``lines`` is read once: a rebalancing shuffle puts a day's lines together, splits a day
    beyond ``split`` bytes (default: the session's advisory partition size) over several tasks
    and lets small days share one, so a day has one file per split. A codec holds for a whole
    write, so the days to be compressed are written again from their own files.
    """
    spark = lines.sparkSession
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        if split:
            spark.conf.set(key, split)
        lines.select("day", "line").hint("rebalance", "day").write.partitionBy("day").text(f"{path}/plain")
    finally:
        spark.conf.set(key, before)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for day in gzip_days:
        plain = jvm.org.apache.hadoop.fs.Path(f"{path}/plain/day={day}")
        fs = plain.getFileSystem(conf)
        if fs.exists(plain):
            spark.read.text(plain.toString()).write.option("compression", "gzip").text(f"{path}/gzip/day={day}")
            fs.delete(plain, True)


def file_day(file_path_col: str = "file_path"):
    """The day a log shard covers, from a ``day=yyyy-MM-dd`` folder in its path."""
    return F.regexp_extract(F.col(file_path_col), r"day=(\d{4}-\d{2}-\d{2})", 1)
