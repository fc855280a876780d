"""Calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_bucket(ts) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def month_bucket(ts) -> Column:
    """'yyyy-MM' text of a timestamp."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM")
