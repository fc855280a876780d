"""Access-log, geo, article and sink queries (F2-F5 of FIXTURES.md).

The oracles read the stored tables directly and never parse log text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.calendar import month_bucket
from quillspark.functions.ip import cidr_bounds as cidr_cols
from quillspark.operators import articles as A
from quillspark.operators import geo as G
from quillspark.operators import weblog as L
from quillspark.plans.registry import register
from quillspark.session import materialized, scratch_path
from quillspark.sources import derived as D
from quillspark.sources import files as IO
from quillspark.sources.tables import table
from quillspark.sources.text import scan_text_glob as read_glob
from quillspark.sources.text import scan_text_lines

YEAR = 2024  # events cover January 2024


def _lines(spark, sf):
    """F2 as text files (written once per application), read like any access log."""
    path = materialized(spark, "access-log-text", sf,
                        lambda p: D.access_log_lines(table(spark, sf, "events")).write.text(p))
    return scan_text_lines(spark, path)


def _parsed(spark, sf):
    return L.parse_access_log(_lines(spark, sf))


def _block_keys(spark, sf):
    """The lookup keys of all blocks with their country, unlisted places included (built once
    per application, like any dimension kept in storage)."""
    path = materialized(spark, "geo-block-keys", sf, lambda p: _write_block_keys(spark, sf, p))
    return spark.read.parquet(path)


def _write_block_keys(spark, sf, path):
    blocks = D.address_blocks(table(spark, sf, "nation"), table(spark, sf, "supplier"))
    places = D.locations(table(spark, sf, "nation"), table(spark, sf, "region"))
    G.block_keys(G.blocks_with_country(blocks, places)).write.parquet(path)


# ---- DuckDB fragments ----------------------------------------------------------------
_HOST = "printf('10.%d.%d.%d', user_id % 25 + 1, user_id % 256, event_id % 256)"
_IPNUM = "(167772160 + (user_id % 25 + 1) * 65536 + (user_id % 256) * 256 + event_id % 256)"
_GOOD = "event_id % 97 <> 0 AND event_id % 89 <> 0"
_PARSED_SQL = f"""
SELECT {_HOST} AS host, '-' AS identity, 'u' || user_id AS "user",
       strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS ts_raw,
       date_trunc('second', ts) AS ts, CAST(ts AS DATE) AS day, 'GET' AS verb,
       '/' || event_type || '/' || (user_id % 50) AS url,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 5000 END AS size,
       '-' AS referrer, 'agent' AS agent
FROM events WHERE {_GOOD}"""
_LINE_SQL = f"""CASE WHEN event_id % 97 = 0 THEN 'junk ' || event_id
ELSE printf('%s - u%d [%s%s +0000] "GET /%s/%d HTTP/1.1" %s %s "-" "agent"', {_HOST}, user_id,
  CASE WHEN event_id % 89 = 0 THEN '?' ELSE '' END, strftime(ts, '%d/%b/%Y:%H:%M:%S'), event_type, user_id % 50,
  CASE WHEN event_type = 'error' THEN '500' ELSE '200' END,
  CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(event_id % 5000 AS VARCHAR) END) END"""
_BLOCKS_SQL = """
SELECT printf('10.%d.0.0/16', n_nationkey + 1) AS network, n_nationkey AS geoname_id
FROM nation WHERE n_nationkey <> 7
UNION ALL
SELECT printf('10.%d.%d.0/24', s_suppkey % 25 + 1, s_suppkey % 256),
  CASE WHEN s_suppkey % 4 = 1 THEN 99 ELSE s_nationkey END FROM supplier"""
_PLACES_SQL = """
SELECT n_nationkey AS geoname_id, 'en' AS locale_code, upper(substr(r_name, 1, 2)) AS continent_code,
       r_name AS continent_name, upper(substr(n_name, 1, 2)) AS country_iso_code,
       CASE WHEN n_nationkey % 5 = 0 THEN n_name || ', Islands' ELSE n_name END AS country_name
FROM nation JOIN region ON n_regionkey = r_regionkey"""
_BOUNDS_SQL = f"""
SELECT network, geoname_id,
  CAST(split_part(network, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(network, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(network, '.', 3) AS BIGINT) * 256
  + CAST(split_part(split_part(network, '.', 4), '/', 1) AS BIGINT) AS start,
  CAST(split_part(network, '/', 2) AS INTEGER) AS prefix
FROM ({_BLOCKS_SQL})"""
_LOCATED_SQL = f"""
WITH hosts AS (SELECT DISTINCT {_HOST} AS host, {_IPNUM} AS ip FROM events WHERE {_GOOD}),
b AS (SELECT *, start + (CAST(1 AS BIGINT) << (32 - prefix)) - 1 AS stop FROM ({_BOUNDS_SQL})),
p AS ({_PLACES_SQL}),
longest AS (
  SELECT h.host, max_by(b.geoname_id, b.prefix * 1000 - b.geoname_id) AS geoname_id
  FROM hosts h LEFT JOIN b ON h.ip BETWEEN b.start AND b.stop GROUP BY h.host)
SELECT l.host, l.geoname_id, p.country_name FROM longest l LEFT JOIN p ON p.geoname_id = l.geoname_id"""


# ---- log parsing and reports -----------------------------------------------------------
@register("parse_access_log", _PARSED_SQL)
def parse_access_log(spark, sf):
    return _parsed(spark, sf)


@register("reject_access_log", f"SELECT {_LINE_SQL} AS line FROM events WHERE NOT ({_GOOD})")
def reject_access_log(spark, sf):
    return L.reject_access_log(_lines(spark, sf))


@register("day_bucket", f"SELECT ts_raw, day FROM ({_PARSED_SQL}) WHERE year(day) = {YEAR}")
def day_bucket(spark, sf):
    return L.in_year(_parsed(spark, sf), YEAR).select("ts_raw", "day")


@register("hits_by_day", f"""
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
WHERE {_GOOD} AND year(ts) = {YEAR} GROUP BY 1 ORDER BY 1""")
def hits_by_day(spark, sf):
    return L.hits_by_day(_parsed(spark, sf), YEAR)


@register("sort_by_date", f"""
SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS pos, day, n FROM (
  SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
  WHERE {_GOOD} AND year(ts) = {YEAR} GROUP BY 1)""")
def sort_by_date(spark, sf):
    return L.sort_by_date(L.hits_by_day(_parsed(spark, sf), YEAR))


@register("top_pages", f"""
SELECT '/' || event_type || '/' || (user_id % 50) AS url, count(*) AS n FROM events
WHERE {_GOOD} GROUP BY 1 ORDER BY n DESC, url LIMIT 20""")
def top_pages(spark, sf):
    return L.top_pages(_parsed(spark, sf), 20)


# ---- scans and sinks -------------------------------------------------------------------
@register("scan_text_glob", f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, {_LINE_SQL} AS line FROM events
WHERE strftime(ts, '%Y-%m') = '2024-01'""")
def scan_text_glob(spark, sf):
    """Log shards in one folder per day (the first of the month gzip), read by a ``??`` glob. The
    shards are written once per application, like logs that lie in storage."""
    root = materialized(spark, "access-log-days", sf, lambda p: IO.write_daily_text(
        D.access_log_lines(table(spark, sf, "events"), with_day=True), p, gzip_days=("2024-01-01",)))
    got = read_glob(spark, f"{root}/*/day=2024-01-??")
    return got.select(IO.file_day().alias("day"), "line")


@register("sink_tsv", f"""
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
WHERE {_GOOD} AND year(ts) = {YEAR} GROUP BY 1""")
def sink_tsv(spark, sf):
    path = scratch_path(spark, "hits-by-day")
    IO.sink_tsv(L.hits_by_day(_parsed(spark, sf), YEAR), path)
    return IO.scan_tsv(spark, path, "day DATE, n BIGINT")


@register("sink_single_file", f"""
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
WHERE {_GOOD} AND year(ts) = {YEAR} GROUP BY 1""")
def sink_single_file(spark, sf):
    path = scratch_path(spark, "hits-by-day-merged")
    IO.sink_single_file(L.hits_by_day(_parsed(spark, sf), YEAR), path, ["day"])
    back = IO.scan_tsv(spark, path, "day DATE, n BIGINT")
    files = back.select(F.input_file_name()).distinct().count()
    if files != 1:
        raise RuntimeError(f"expected one file, found {files}")
    return back


# ---- address blocks and places ---------------------------------------------------------
def _write_dims(spark, sf, root):
    IO.write_csv(D.address_blocks(table(spark, sf, "nation"), table(spark, sf, "supplier")),
                 f"{root}/blocks")
    IO.write_csv(D.locations(table(spark, sf, "nation"), table(spark, sf, "region")),
                 f"{root}/locations")


def _written_dims(spark, sf):
    """F3 and F4 as CSV files with a header (written once per application)."""
    root = materialized(spark, "geo-csv", sf, lambda p: _write_dims(spark, sf, p))
    return (IO.scan_csv_dim(spark, f"{root}/blocks", IO.BLOCKS_SCHEMA),
            IO.scan_csv_dim(spark, f"{root}/locations", IO.LOCATIONS_SCHEMA))


@register("scan_csv_dim", _PLACES_SQL)
def scan_csv_dim(spark, sf):
    return _written_dims(spark, sf)[1]


@register("join_blocks_country", f"""
SELECT b.network, b.geoname_id, p.country_name FROM ({_BLOCKS_SQL}) b JOIN ({_PLACES_SQL}) p
ON b.geoname_id = p.geoname_id""")
def join_blocks_country(spark, sf):
    blocks, places = _written_dims(spark, sf)
    return G.join_blocks_country(blocks, places)


@register("split_columns", f"SELECT network, geoname_id FROM ({_BLOCKS_SQL})")
def split_columns(spark, sf):
    """Comma-joined block lines cut back into typed columns by position."""
    blocks = D.address_blocks(table(spark, sf, "nation"), table(spark, sf, "supplier"))
    text = blocks.select(F.concat_ws(",", "network", "geoname_id").alias("line"))
    parts = F.split("line", ",", -1)
    return text.select(F.get(parts, 0).alias("network"),
                       F.get(parts, 1).try_cast("int").alias("geoname_id"))


@register("cidr_bounds", f"""
SELECT network, start, start + (CAST(1 AS BIGINT) << (32 - prefix)) - 1 AS "end", prefix
FROM ({_BOUNDS_SQL})""")
def cidr_bounds(spark, sf):
    blocks = D.address_blocks(table(spark, sf, "nation"), table(spark, sf, "supplier"))
    return blocks.select("network", *cidr_cols("network"))


@register("geolocate_ip", _LOCATED_SQL)
def geolocate_ip(spark, sf):
    hosts = _parsed(spark, sf).select("host").distinct()
    return G.geolocate_ip(hosts, None, "host", keys=_block_keys(spark, sf))


@register("hits_by_country", f"""
WITH located AS ({_LOCATED_SQL})
SELECT l.country_name, count(*) AS n
FROM (SELECT {_HOST} AS host FROM events WHERE {_GOOD}) e JOIN located l ON e.host = l.host
GROUP BY 1""")
def hits_by_country(spark, sf):
    return G.hits_by_country(_parsed(spark, sf), None, _block_keys(spark, sf))


def build_inputs(spark, sf):
    """Write every derived input once, as it would already sit in storage."""
    for build in (_lines, _written_dims, _block_keys, _articles):
        build(spark, sf)


# ---- article dump ------------------------------------------------------------------------
_ARTICLES_SQL = """SELECT o_orderkey AS id, 'Article ' || o_orderkey AS title, o_orderdate AS ts,
o_orderpriority AS body FROM orders"""


def _articles(spark, sf):
    """F5 as a tab-separated dump (written once per application)."""
    path = materialized(spark, "articles-tsv", sf,
                        lambda p: IO.sink_tsv(D.article_rows(table(spark, sf, "orders")), p))
    return IO.scan_tsv(spark, path, IO.ARTICLES_SCHEMA)


@register("scan_tsv_articles", _ARTICLES_SQL)
def scan_tsv_articles(spark, sf):
    return _articles(spark, sf)


@register("month_bucket", "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def month_bucket_q(spark, sf):
    return _articles(spark, sf).select("id", month_bucket("ts").alias("month"))


@register("articles_by_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1""")
def articles_by_month(spark, sf):
    return A.articles_by_month(_articles(spark, sf))
