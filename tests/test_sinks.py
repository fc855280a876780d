"""Sinks: overwrite, one ordered file for small results, ordered part files beyond."""

import glob
import os

from quillspark.sources import files as IO


def _parts(path):
    return sorted(p for p in glob.glob(os.path.join(path, "part-*")))


def test_sink_tsv_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    IO.sink_tsv(spark.createDataFrame([("a", 1)], "w string, n long"), path)
    IO.sink_tsv(spark.createDataFrame([("b", 2), ("c", 3)], "w string, n long"), path)
    got = sorted(tuple(r) for r in IO.scan_tsv(spark, path, "w string, n long").collect())
    assert got == [("b", 2), ("c", 3)]


def test_single_file_is_ordered(spark, tmp_path):
    path = str(tmp_path / "one")
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "k int, v int").repartition(5)
    IO.sink_single_file(df, path, ["k", "v"])
    files = _parts(path)
    assert len(files) == 1
    rows = [tuple(map(int, line.split("\t"))) for line in open(files[0]).read().splitlines()]
    assert rows == sorted((i % 7, i) for i in range(50))


def test_any_number_of_parts_becomes_one_file(spark, tmp_path):
    path = str(tmp_path / "many")
    df = spark.createDataFrame([((i * 37) % 101, i) for i in range(300)], "k int, v int").repartition(4)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")     # several sorted part files on tiny data
    try:
        IO.sink_single_file(df, path, ["k", "v"])
        IO.sink_single_file(df, path, ["k", "v"])     # replaces the older result
    finally:
        spark.conf.set(key, old)
    files = _parts(path)
    assert len(files) == 1
    rows = [tuple(map(int, line.split("\t"))) for line in open(files[0]).read().splitlines()]
    assert rows == sorted(((i * 37) % 101, i) for i in range(300))


def test_daily_files_one_a_day_and_split(spark, tmp_path):
    """Small days have one file each, a day beyond the bound several of about its size; no line
    is lost, and the days named are gzip."""
    from pyspark.sql import functions as F
    from quillspark.sources import files as IO
    from quillspark.sources.text import scan_text_glob
    noise = F.sha2(F.col("id").cast("string"), 512)  # does not compress
    rows = spark.range(40_000).select(
        F.when(F.col("id") < 36_000, F.lit("2024-01-05")).otherwise(F.concat(F.lit("2024-01-1"), (F.col("id") % 4).cast("string"))).alias("day"),
        F.concat(noise, noise).alias("line")).repartition(6)
    IO.write_daily_text(rows, str(tmp_path / "logs"), gzip_days=("2024-01-11", "2030-01-01"), split="1m")
    files = {d: len(glob.glob(str(tmp_path / "logs" / "plain" / f"day={d}" / "part-*"))) for d in
             ("2024-01-05", "2024-01-10", "2024-01-11", "2024-01-12", "2024-01-13")}
    assert files["2024-01-05"] >= 3 and files["2024-01-11"] == 0
    assert [files[f"2024-01-1{i}"] for i in (0, 2, 3)] == [1, 1, 1]
    assert len(glob.glob(str(tmp_path / "logs" / "gzip" / "day=2024-01-11" / "*.gz"))) == 1
    got = scan_text_glob(spark, str(tmp_path / "logs" / "*" / "day=2024-01-??")).select(IO.file_day().alias("day"), "line")
    assert got.exceptAll(rows).count() == 0 and rows.exceptAll(got).count() == 0
