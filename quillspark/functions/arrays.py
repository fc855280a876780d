"""Arrays to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, arr: Column | str, keep: Sequence[str | Column],
                 value: str = "v", pos: str | None = None) -> DataFrame:
    """One row per array element, exactly like ``posexplode`` / ``explode``.

    Written as ``posexplode_outer`` plus a position filter: for a plain ``explode`` the
    optimizer infers a ``size(arr) > 0`` pre-filter, which evaluates ``arr`` a second
    time (a regex split or an array expression) and is pushed below any repartition.
    The outer form gets no such filter; dropping the NULL-position row of a NULL or
    empty array restores the inner semantics.
    """
    arr = F.col(arr) if isinstance(arr, str) else arr
    p = pos or "_pos"
    out = df.select(*keep, F.posexplode_outer(arr).alias(p, value)).where(F.col(p).isNotNull())
    return out if pos else out.drop(p)
