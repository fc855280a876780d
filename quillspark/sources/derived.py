"""Inputs derived from the stored tables (FIXTURES.md part 2).

The stored tables stand in for the raw files the reports read: access logs are rendered
from ``events``, address blocks from ``nation`` and ``supplier``, places from ``nation``
and ``region``, the article dump from ``orders``. Spark derives all of them, so their
size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import bounded_broadcast

# The rendered access-log line (F2). Every 97th event becomes a junk
# line; every 89th has a time that cannot be read; every 11th size is '-'.
_LOG_LINE_SQL = """
CASE WHEN event_id % 97 = 0 THEN concat('junk ', event_id)
ELSE format_string('10.%d.%d.%d - u%d [%s%s +0000] "GET /%s/%d HTTP/1.1" %s %s "-" "agent"',
  user_id % 25 + 1, user_id % 256, event_id % 256, user_id,
  CASE WHEN event_id % 89 = 0 THEN '?' ELSE '' END, date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), event_type, user_id % 50,
  CASE WHEN event_type = 'error' THEN '500' ELSE '200' END,
  CASE WHEN event_id % 11 = 0 THEN '-' ELSE cast(event_id % 5000 AS string) END) END
"""


def log_line_expr() -> Column:
    return F.expr(_LOG_LINE_SQL)


def access_log_lines(events: DataFrame, with_day: bool = False) -> DataFrame:
    """one access-log line per event (``line``), optionally with its calendar day."""
    cols = [log_line_expr().alias("line")]
    if with_day:
        cols.append(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return events.select(*cols)


def address_blocks(nation: DataFrame, supplier: DataFrame) -> DataFrame:
    """F3 (network, geoname_id): a /16 per nation but nation 7, nested /24s per supplier; every
    fourth nested block belongs to a place (99) that is not listed."""
    wide = (nation.where(F.col("n_nationkey") != 7)
            .select(F.format_string("10.%d.0.0/16", F.col("n_nationkey") + 1).alias("network"),
                    F.col("n_nationkey").cast("int").alias("geoname_id")))
    narrow = supplier.select(
        F.format_string("10.%d.%d.0/24", F.col("s_suppkey") % 25 + 1, F.col("s_suppkey") % 256)
        .alias("network"),
        F.when(F.col("s_suppkey") % 4 == 1, F.lit(99)).otherwise(F.col("s_nationkey")).cast("int")
        .alias("geoname_id"))
    return wide.unionByName(narrow)


def locations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """F4 places: every fifth country name carries a comma (quoted in CSV)."""
    name = F.when(F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit(", Islands"))) \
        .otherwise(F.col("n_name"))
    return (nation.join(bounded_broadcast(region, 100_000), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("int").alias("geoname_id"),
                    F.lit("en").alias("locale_code"),
                    F.upper(F.substring("r_name", 1, 2)).alias("continent_code"),
                    F.col("r_name").alias("continent_name"),
                    F.upper(F.substring("n_name", 1, 2)).alias("country_iso_code"),
                    name.alias("country_name")))


def article_rows(orders: DataFrame) -> DataFrame:
    """F5 article dump (id, title, ts, body)."""
    return orders.select(F.col("o_orderkey").alias("id"),
                         F.concat(F.lit("Article "), F.col("o_orderkey")).alias("title"),
                         F.col("o_orderdate").alias("ts"),
                         F.col("o_orderpriority").alias("body"))
