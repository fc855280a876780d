"""The stored parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Only scans this small (in splits) are spread: the added shuffle then moves at most a
# few splits' worth of data, never a large table.
SPREAD_MAX_SPLITS = 4


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan of very few splits over the cluster's task slots.

    A parquet row group is the smallest scan split, so a table stored as one big row
    group is read by one task. Tables with more than SPREAD_MAX_SPLITS splits are
    returned unchanged (their scan is already parallel, and spreading them would shuffle
    a large input). Column pruning and filters still reach the scan.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    if n < slots and n <= SPREAD_MAX_SPLITS:
        return df.repartition(slots)
    return df


# Tables whose rows carry heavy per-row work (whole texts, log events, feature vectors).
# Dimension tables feed broadcast sides and are read as they are.
HEAVY_ROW_TABLES = frozenset({"documents", "events", "embeddings", "pages", "conversations"})


def table(spark: SparkSession, sf_dir: str, name: str, spread_scan: bool | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread_scan is None:
        spread_scan = name in HEAVY_ROW_TABLES
    return spread(df) if spread_scan else df
