"""Articles per month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.calendar import month_bucket


def articles_by_month(articles: DataFrame, ts_col: str = "ts") -> DataFrame:
    """(month, n) in month order; the caller names the time column of its dump."""
    return (articles.groupBy(month_bucket(ts_col).alias("month"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("month"))
