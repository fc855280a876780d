"""Access-log fields as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The combined-log pattern of the reports (10 groups: host, identity,
# user, time, verb, url, status, size, referrer, agent) and the time layout in it.
ACCESS_LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(\S+) (\S+) \S+" (\S+) (\S+) "([^"]*)" "([^"]*)"'
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"

GROUPS = ("host", "identity", "user", "ts_raw", "verb", "url", "status", "size",
          "referrer", "agent")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def readable(line) -> Column:
    """An array of one struct (parts, ts) for a line that can be read, else empty: the ten groups
    by one pass of the pattern, and the local time. A line holds no newline, so one can part
    the groups."""
    to_groups = "\n".join(f"${i + 1}" for i in range(len(GROUPS)))
    one = F.filter(F.array(_c(line)), lambda x: ~x.contains("\n"))
    parts = F.transform(one, lambda x: F.split(F.regexp_replace(x, ACCESS_LOG_PATTERN + ".*$", to_groups), "\n", -1))
    matched = F.filter(parts, lambda p: F.size(p) == len(GROUPS))
    timed = F.transform(matched, lambda p: F.struct(p.alias("parts"), local_time(group(p, "ts_raw")).alias("ts")))
    return F.filter(timed, lambda s: s["ts"].isNotNull())


def group(parts, name: str) -> Column:
    return F.get(_c(parts), GROUPS.index(name))


def local_time(ts_raw) -> Column:
    """Wall-clock time of the log, read before the zone offset (so no session zone enters).

    ANSI mode is on, so the strict parse only runs on text the lenient parse accepts.
    """
    local = F.substring_index(_c(ts_raw), " ", 1)
    ok = F.try_to_timestamp(local, F.lit(LOG_TIME_FORMAT)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(local, F.lit(LOG_TIME_FORMAT)))


def parsed_columns(parts, ts) -> list[Column]:
    """Typed fields of a line's groups; status and size use try_cast ('-' is a size)."""
    return [
        group(parts, "host").alias("host"),
        group(parts, "identity").alias("identity"),
        group(parts, "user").alias("user"),
        group(parts, "ts_raw").alias("ts_raw"),
        _c(ts).alias("ts"),
        F.to_date(_c(ts)).alias("day"),
        group(parts, "verb").alias("verb"),
        group(parts, "url").alias("url"),
        group(parts, "status").try_cast("int").alias("status"),
        group(parts, "size").try_cast("bigint").alias("size"),
        group(parts, "referrer").alias("referrer"),
        group(parts, "agent").alias("agent"),
    ]
