"""The streaming day report equals the batch one, across two arrivals of files."""

from quillspark.operators import weblog as L
from quillspark.streaming.logs import run_daily_hits

LINE = 'h - u [{d}/Jan/2012:10:00:00 +0000] "GET /p HTTP/1.1" 200 5 "-" "a"'


def test_stream_matches_batch_after_restart(spark, tmp_path):
    logs, out, ck = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    logs.mkdir()
    (logs / "a.log").write_text("\n".join([LINE.format(d="01"), LINE.format(d="02"), "junk"]) + "\n")
    q = run_daily_hits(spark, str(logs), out, ck, year=2012)
    q.awaitTermination(120)
    (logs / "b.log").write_text("\n".join([LINE.format(d="02"), LINE.format(d="03")]) + "\n")
    q = run_daily_hits(spark, str(logs), out, ck, year=2012)   # resumes from the checkpoint
    q.awaitTermination(120)
    got = sorted((r.day.isoformat(), r.n) for r in spark.read.parquet(out).collect())
    batch = L.hits_by_day(L.parse_access_log(spark.read.text(str(logs)).withColumnRenamed("value", "line")), 2012)
    assert got == sorted((r.day.isoformat(), r.n) for r in batch.collect())
    assert got == [("2012-01-01", 1), ("2012-01-02", 2), ("2012-01-03", 1)]
