"""Address blocks to countries: join on place id, longest-prefix match, hits per country.

No range join. A block table that may be broadcast is probed by equi-joins: for each prefix
length p present (at most 33), an address's key is ``ip >> (32 - p)`` and a block's key is
``start >> (32 - p)``, longest prefix first. A larger one is merged with the addresses over
common ranges of the address space, its nested blocks flattened to disjoint intervals. Nested
blocks are exact either way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import ip as IP
from quillspark.session import bounded_broadcast, checkpointed, ship_package

# Place tables (countries) stay in the hundreds of rows; block tables in the low millions.
MAX_BROADCAST_PLACES = 100_000
# A block table is broadcast within both bounds: rows (the hash table's slots) and bytes.
MAX_BROADCAST_BLOCKS = 4_000_000
MAX_BROADCAST_BYTES = 256 << 20
# A broadcast row without its country name: key, place id, row header, hash slot.
BROADCAST_ROW_BYTES = 64


def join_blocks_country(blocks: DataFrame, places: DataFrame) -> DataFrame:
    """(network, geoname_id, country_name): inner equi-join on the place id."""
    p = bounded_broadcast(places.select("geoname_id", "country_name"), MAX_BROADCAST_PLACES)
    return blocks.select("network", "geoname_id").join(p, "geoname_id", "inner") \
        .select("network", "geoname_id", "country_name")


def blocks_with_country(blocks: DataFrame, places: DataFrame) -> DataFrame:
    """(network, geoname_id, country_name) of every block; a place that is not listed has no
    country. Lookups use this, so that an unlisted nested block still hides the wider one."""
    p = bounded_broadcast(places.select("geoname_id", "country_name"), MAX_BROADCAST_PLACES)
    return blocks.select("network", "geoname_id").join(p, "geoname_id", "left") \
        .select("network", "geoname_id", "country_name")


def block_keys(blocks_country: DataFrame) -> DataFrame:
    """Blocks with the equi-join key for their own prefix, one row per (plen, key).

    Duplicate blocks (same network twice) keep the smallest place id, so a lookup never
    multiplies rows.
    """
    b = blocks_country.select("*", *IP.cidr_bounds("network"))
    b = b.where(F.col("prefix").between(0, 32) & F.col("start").isNotNull())
    b = b.select(F.col("prefix").alias("plen"),
                 F.call_function("shiftright", F.col("start"), 32 - F.col("prefix")).alias("key"),
                 "geoname_id", "country_name")
    best = F.min_by(F.struct("geoname_id", "country_name"), F.col("geoname_id"))
    return b.groupBy("plen", "key").agg(best.alias("_b")) \
        .select("plen", "key", "_b.geoname_id", "_b.country_name")


def geolocate_ip(df: DataFrame, blocks_country: DataFrame | None, ip_col: str = "host",
                 carry: tuple[str, ...] | None = None, keys: DataFrame | None = None) -> DataFrame:
    """``df`` plus (geoname_id, country_name) of each address; unplaced -> NULLs.

    ``keys``: the blocks as ``block_keys`` gives them, already stored (else they are built and
    checkpointed here).

    Broadcast plan (block table within MAX_BROADCAST_BLOCKS rows and MAX_BROADCAST_BYTES): the
    block table is broadcast once, and one hash join per prefix length present probes it,
    longest first, filling only rows still unplaced. It is map-only, so any number of rows (log
    lines, distinct hosts) can be placed with no shuffle. Larger block tables use
    ``_geolocate_merged``.
    """
    # The block table is small next to the rows it places: the stats job and every lookup
    # step read the same files.
    if keys is None:
        keys = checkpointed(block_keys(blocks_country))
    # One small job gives the prefix lengths present (at most 33 rows: 0..32) and the
    # size of the block table that decides between broadcasts and the merge.
    size = F.sum(F.lit(BROADCAST_ROW_BYTES) + F.coalesce(F.octet_length("country_name"), F.lit(0)))
    stats = keys.groupBy("plen").agg(F.count(F.lit(1)).alias("n"), size.alias("size")).collect()
    plens = sorted((r["plen"] for r in stats), reverse=True)
    n_blocks, n_bytes = sum(r["n"] for r in stats), sum(r["size"] for r in stats)
    cols = list(df.columns) if carry is None else [ip_col, *carry]
    if n_blocks > MAX_BROADCAST_BLOCKS or n_bytes > MAX_BROADCAST_BYTES:
        return _geolocate_merged(df.select(*cols), keys, n_blocks, ip_col, cols)
    # One build side for every step: (plen, key) packed into one long (key < 2^32), so the
    # same broadcast exchange is reused by all the joins.
    side = F.broadcast(keys.select(
        (F.col("plen").cast("long") * (1 << 33) + F.col("key")).alias("_bk"),
        F.col("geoname_id").alias("_bg"), F.col("country_name").alias("_bc")))
    out = df.select(*cols, IP.ip_to_long(ip_col).alias("_ip"), F.lit(False).alias("_hit"),
                    F.lit(None).cast("int").alias("geoname_id"),
                    F.lit(None).cast("string").alias("country_name"))
    for p in plens:
        # Rows placed by a longer prefix get a NULL probe key, so they match nothing here.
        probe = F.when(~F.col("_hit"),
                       F.lit(p * (1 << 33)) + F.call_function("shiftright", F.col("_ip"), F.lit(32 - p)))
        hit = F.col("_bk").isNotNull()
        out = (out.withColumn("_pk", probe).join(side, F.col("_pk") == F.col("_bk"), "left")
               .select(*cols, "_ip", (F.col("_hit") | hit).alias("_hit"),
                       F.when(hit, F.col("_bg")).otherwise(F.col("geoname_id")).alias("geoname_id"),
                       F.when(hit, F.col("_bc")).otherwise(F.col("country_name")).alias("country_name")))
    return out.drop("_ip", "_hit")


def _geolocate_merged(df: DataFrame, keys: DataFrame, n_blocks: int, ip_col: str, cols: list[str]) -> DataFrame:
    """Shuffle plan for block tables too big to broadcast: the distinct addresses and the blocks
    are dealt to the same address ranges and merged there (``merge_blocks``), and the answers are
    joined back to the rows, which thus keep their number. An address is one row, however many
    prefix lengths there are. Rows without a readable address never enter the merge."""
    rows = df.withColumn("_ip", IP.ip_to_long(ip_col))
    no_place = [F.lit(None).cast("int").alias("geoname_id"), F.lit(None).cast("string").alias("country_name")]
    if not n_blocks:
        return rows.select(*cols, *no_place)
    addresses = checkpointed(rows.where(F.col("_ip").isNotNull()).select("_ip").distinct())
    blocks = keys.select(F.call_function("shiftleft", F.col("key"), 32 - F.col("plen")).alias("start"),
                         "plen", "geoname_id", "country_name")
    placed = merge_blocks(addresses, blocks)
    known = rows.where(F.col("_ip").isNotNull()).join(placed, "_ip", "left") \
        .select(*cols, "geoname_id", "country_name")
    return known.unionAll(rows.where(F.col("_ip").isNull()).select(*cols, *no_place))


# Addresses and block starts of one range of the merge, and ranges at most (their bounds are
# shipped to the tasks; there are 2^32 addresses, so more are never wanted).
ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 1 << 14


def address_ranges(addresses: DataFrame, blocks: DataFrame, ranges: int) -> list[int]:
    """First addresses of at most ``ranges`` ranges that hold about equally many of the distinct
    ``addresses`` (_ip) and blocks (by start); the first range starts at 0."""
    if ranges < 2:
        return [0]
    both = addresses.select(F.col("_ip").cast("double").alias("v")) \
        .unionAll(blocks.select(F.col("start").cast("double")))
    cuts = both.approxQuantile("v", [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    return sorted({0, *(int(c) for c in cuts)})


def flatten_blocks(start: np.ndarray, plen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint intervals of nested blocks: (first address, index of the innermost block or -1),
    each up to the next one's first address.

    ``start``, ``plen``: distinct blocks, sorted. Prefix blocks are nested or disjoint, so the
    sweep keeps the stack of the blocks that are still open, at most one a prefix length.
    """
    firsts, answers, stack = [], [], []

    def goes_on(at: int, answer: int) -> None:
        if firsts and firsts[-1] == at:
            answers[-1] = answer
        else:
            firsts.append(at)
            answers.append(answer)

    ends = start + (np.int64(1) << (32 - plen.astype(np.int64)))
    for i, (s, e) in enumerate(zip(start.tolist(), ends.tolist())):
        while stack and stack[-1][0] <= s:
            closed = stack.pop()[0]
            goes_on(closed, stack[-1][1] if stack else -1)
        goes_on(s, i)
        stack.append((e, i))
    while stack:
        closed = stack.pop()[0]
        goes_on(closed, stack[-1][1] if stack else -1)
    return np.array(firsts, np.int64), np.array(answers, np.int64)


def merge_blocks(addresses: DataFrame, blocks: DataFrame, ranges: int | None = None) -> DataFrame:
    """(_ip, geoname_id, country_name) of the distinct ``addresses`` (_ip) that lie in a block:
    the place of the longest prefix.

    ``blocks``: distinct (start, plen, geoname_id, country_name). Both tables are dealt to ranges
    of the address space; a block goes to every range it reaches into, which adds at most 33 rows
    a range (blocks that hold the same address differ in prefix length), so a /0 block is one row
    a range and no key is hot. In its range a task flattens the blocks to disjoint intervals and
    looks its addresses up batch by batch.
    """
    spark = addresses.sparkSession
    ship_package(spark)
    if ranges is None:
        wanted = -(-(addresses.count() + blocks.count()) // ROWS_PER_RANGE)
        ranges = min(MAX_RANGES, max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds = np.array(address_ranges(addresses, blocks, ranges), np.int64)

    @F.pandas_udf("int")
    def range_of(v: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, v.to_numpy(np.int64), "right") - 1).astype("int32")

    end = F.col("start") + F.call_function("shiftleft", F.lit(1).cast("bigint"), 32 - F.col("plen")) - 1
    held = blocks.withColumn("first", range_of("start")).withColumn("last", range_of(end)) \
        .select(F.explode(F.sequence("first", "last")).alias("part"), F.lit(0).alias("kind"), F.col("start").alias("at"),
                "plen", "geoname_id", "country_name")
    asked = addresses.select(range_of("_ip").alias("part"), F.lit(1).alias("kind"), F.col("_ip").alias("at"),
                             F.lit(None).cast("int").alias("plen"), F.lit(None).cast("int").alias("geoname_id"),
                             F.lit(None).cast("string").alias("country_name"))
    dealt = held.unionAll(asked).repartitionById(len(bounds), F.col("part")) \
        .sortWithinPartitions("kind", "at", "plen")

    def run(batches):
        block_rows, firsts, answers, places = [], None, None, None
        for b in batches:
            kind = b.column(1).to_numpy(zero_copy_only=False)
            n = int(np.searchsorted(kind, 1))  # the blocks come first
            if n:
                block_rows.append(b.slice(0, n).select([2, 3, 4, 5]))
            if n == b.num_rows or not block_rows:
                continue
            if firsts is None:
                places = pa.Table.from_batches(block_rows).combine_chunks()
                firsts, answers = flatten_blocks(places.column(0).to_numpy(), places.column(1).to_numpy())
            at = b.column(2).to_numpy(zero_copy_only=False)[n:]
            where = np.searchsorted(firsts, at, "right") - 1
            hit = np.where(where >= 0, answers[np.maximum(where, 0)], -1)
            inside = hit >= 0
            found = places.take(pa.array(hit[inside]))
            for part in found.append_column("_ip", pa.array(at[inside])).select([4, 2, 3]).to_batches():
                yield part

    return dealt.mapInArrow(run, "_ip long, geoname_id int, country_name string")


def hits_by_country(parsed: DataFrame, blocks_country: DataFrame | None,
                    keys: DataFrame | None = None) -> DataFrame:
    """(country_name, n): log lines per country of their host; NULL = no block.

    Hosts are counted first (map-side combine), so the lookup sees each address once
    however hot it is; with broadcast blocks the lookup itself adds no shuffle.
    """
    per_host = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("hits"))
    located = geolocate_ip(per_host, blocks_country, "host", carry=("hits",), keys=keys)
    return located.groupBy("country_name").agg(F.sum("hits").alias("n"))
