"""Access-log reports: parse, reject, hits per day, top pages.

All map-side until the final group-by; the parse is a projection (no Python), so the
scan, the regex work and the partial count share one whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import weblog as L


def _read(lines: DataFrame, line_col: str) -> DataFrame:
    """Lines with their groups and time; ``_pos`` is NULL for a line that cannot be read.

    Generating the row (rather than filtering on it) keeps the pattern to one pass: a filter on
    the parsed time would be pushed below and parse the line again.
    """
    return (lines.select(F.col(line_col).alias("_line"), F.posexplode_outer(L.readable(line_col)).alias("_pos", "_r"))
            .select("_line", "_pos", "_r.parts", "_r.ts"))


def parse_access_log(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Typed fields of every line that matches the pattern and has a readable time; all other
    lines are in ``reject_access_log``."""
    return _read(lines, line_col).where(F.col("_pos").isNotNull()).select(*L.parsed_columns("parts", "ts"))


def reject_access_log(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """The complement of ``parse_access_log``: lines that do not match, null and empty lines,
    and lines whose time cannot be read."""
    return _read(lines, line_col).where(F.col("_pos").isNull()).select(F.col("_line").alias("line"))


def in_year(parsed: DataFrame, year: int | None) -> DataFrame:
    return parsed if year is None else parsed.where(F.year("day") == year)


def with_status(parsed: DataFrame, statuses=None) -> DataFrame:
    """Keep only lines whose status is in ``statuses`` (None keeps every parsed line)."""
    return parsed if statuses is None else parsed.where(F.col("status").isin(list(statuses)))


def hits_by_day(parsed: DataFrame, year: int | None = None, statuses=None) -> DataFrame:
    """(day, n): URLs served each day, in day order; optionally only some statuses."""
    return (in_year(with_status(parsed, statuses), year).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("day"))


def sort_by_date(daily: DataFrame) -> DataFrame:
    """(pos, day, n): the daily counts with their place in date order.

    The window has no partition key, so it runs in one task; its input is one row per
    calendar day (bounded by the days of the chosen year span), never raw log rows.
    """
    w = Window.orderBy("day")
    return daily.select((F.row_number().over(w) - 1).cast("bigint").alias("pos"), "day", "n")


def top_pages(parsed: DataFrame, k: int = 20, strip_query: bool = False, statuses=None) -> DataFrame:
    """(url, n): the k most requested pages, most requested first, ties by url."""
    url = F.substring_index("url", "?", 1) if strip_query else F.col("url")
    counts = with_status(parsed, statuses).groupBy(url.alias("url")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("url")).limit(k)
