"""Hits per day over a folder that keeps receiving access-log files.

The same parse and count as the batch report, run by Structured Streaming: each new
file is parsed once, the per-day counts live in the state store (one row per day, so
the state stays bounded by the calendar), and every trigger rewrites the small result
table. Source progress and state are kept under the shared checkpoint folder, so a
restarted or failed job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import weblog as L


def daily_hits_stream(spark: SparkSession, log_dir: str, year: int | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (day, n) over the text files arriving in ``log_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(log_dir).withColumnRenamed("value", "line")
    parsed = L.in_year(L.parse_access_log(lines), year)
    return parsed.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def run_daily_hits(spark: SparkSession, log_dir: str, out_path: str, checkpoint: str,
                   year: int | None = None, available_now: bool = True):
    """Start the stream; each trigger overwrites ``out_path`` with the full day table.

    With ``available_now`` the query processes every file present and stops (a
    restartable batch); otherwise it keeps running on new files.
    """
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    w = (daily_hits_stream(spark, log_dir, year).writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
