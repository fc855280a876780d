"""Address blocks: bounds, nested prefixes, /0 and /32, gaps, CSV quoting."""

from quillspark.functions.ip import cidr_bounds, ip_to_long
from quillspark.operators import geo as G
from quillspark.sources import files as IO


def _blocks(spark, rows):
    return spark.createDataFrame(rows, "network string, geoname_id int, country_name string")


def test_cidr_bounds(spark):
    df = spark.createDataFrame([("1.11.0.0/16",), ("11.1.0.0/16",), ("0.0.0.0/0",), ("9.9.9.9/32",),
                                ("10.0.0.77/24",)], "network string")
    got = {r.network: (r.start, r.end, r.prefix) for r in df.select("network", *cidr_bounds("network")).collect()}
    assert got["1.11.0.0/16"] == (17498112, 17563647, 16)
    assert got["11.1.0.0/16"] == (184614912, 184680447, 16)   # no collision with the above
    assert got["0.0.0.0/0"] == (0, 4294967295, 0)
    assert got["9.9.9.9/32"] == (151587081, 151587081, 32)
    assert got["10.0.0.77/24"][0] == 167772160                # host bits cleared


def test_ip_to_long_rejects_bad_text(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("1.2.3",), ("a.b.c.d",), ("1.2.3.256",), (None,)], "ip string")
    assert [r.v for r in df.select(ip_to_long("ip").alias("v")).collect()] == [16909060, None, None, None, None]


def test_longest_prefix_wins_and_gaps_are_null(spark):
    blocks = _blocks(spark, [("10.0.0.0/8", 1, "Wide"), ("10.1.0.0/16", 2, "Mid"),
                             ("10.1.2.0/24", 3, "Narrow"), ("10.1.2.3/32", 4, "Host"),
                             ("0.0.0.0/0", 9, "World")])
    hosts = spark.createDataFrame([("10.1.2.3",), ("10.1.2.4",), ("10.1.9.9",), ("10.200.0.1",),
                                   ("11.0.0.1",), ("not-an-ip",)], "host string")
    got = {r.host: r.country_name for r in G.geolocate_ip(hosts, blocks).collect()}
    assert got == {"10.1.2.3": "Host", "10.1.2.4": "Narrow", "10.1.9.9": "Mid", "10.200.0.1": "Wide",
                   "11.0.0.1": "World", "not-an-ip": None}


def test_address_outside_all_blocks(spark):
    blocks = _blocks(spark, [("10.1.0.0/16", 2, "Mid")])
    hosts = spark.createDataFrame([("192.168.0.1",)], "host string")
    r = G.geolocate_ip(hosts, blocks).first()
    assert r.geoname_id is None and r.country_name is None


def test_hits_by_country_counts_lines(spark):
    blocks = _blocks(spark, [("10.1.0.0/16", 2, "Mid")])
    parsed = spark.createDataFrame([("10.1.0.1",), ("10.1.0.1",), ("10.1.0.2",), ("8.8.8.8",)], "host string")
    got = {r.country_name: r.n for r in G.hits_by_country(parsed, blocks).collect()}
    assert got == {"Mid": 3, None: 1}


def test_csv_header_and_quoted_comma(spark, tmp_path):
    p = tmp_path / "loc.csv"
    p.write_text('geoname_id,locale_code,continent_code,continent_name,country_iso_code,country_name\n'
                 '5,en,AF,AFRICA,XX,"Some, Islands"\n6,en,EU,EUROPE,YY,Plain\n')
    df = IO.scan_csv_dim(spark, str(p), IO.LOCATIONS_SCHEMA)
    got = {r.geoname_id: r.country_name for r in df.collect()}
    assert got == {5: "Some, Islands", 6: "Plain"}


def test_join_blocks_country_is_inner(spark):
    blocks = spark.createDataFrame([("10.1.0.0/16", 1), ("10.2.0.0/16", 2)], "network string, geoname_id int")
    places = spark.createDataFrame([(1, "One")], "geoname_id int, country_name string")
    got = [tuple(r) for r in G.join_blocks_country(blocks, places).collect()]
    assert got == [("10.1.0.0/16", 1, "One")]


def test_shuffled_plan_equals_broadcast_plan(spark, monkeypatch):
    blocks = _blocks(spark, [("10.0.0.0/8", 1, "Wide"), ("10.1.0.0/16", 2, "Mid"),
                             ("10.1.2.0/24", 3, "Narrow"), ("10.1.2.0/24", 5, "Dup")])
    hosts = spark.createDataFrame([("10.1.2.3",), ("10.1.9.9",), ("10.9.0.1",), ("1.1.1.1",)], "host string")
    fast = {r.host: (r.geoname_id, r.country_name) for r in G.geolocate_ip(hosts, blocks).collect()}
    monkeypatch.setattr(G, "MAX_BROADCAST_BLOCKS", 0)
    slow = {r.host: (r.geoname_id, r.country_name) for r in G.geolocate_ip(hosts, blocks).collect()}
    assert fast == slow == {"10.1.2.3": (3, "Narrow"), "10.1.9.9": (2, "Mid"),
                            "10.9.0.1": (1, "Wide"), "1.1.1.1": (None, None)}


def test_lookup_keeps_every_row(spark):
    blocks = _blocks(spark, [("10.1.0.0/16", 2, "Mid")])
    lines = spark.createDataFrame([("10.1.0.1", 1), ("10.1.0.1", 2), ("9.9.9.9", 3)], "host string, k int")
    got = sorted((r.k, r.country_name) for r in G.geolocate_ip(lines, blocks).collect())
    assert got == [(1, "Mid"), (2, "Mid"), (3, None)]


def test_longest_match_kept_when_its_country_is_null(spark):
    blocks = _blocks(spark, [("10.0.0.0/8", 1, "Wide"), ("10.1.0.0/16", 2, None)])
    hosts = spark.createDataFrame([("10.1.0.1",), ("10.2.0.1",)], "host string")
    got = {r.host: (r.geoname_id, r.country_name) for r in G.geolocate_ip(hosts, blocks).collect()}
    assert got == {"10.1.0.1": (2, None), "10.2.0.1": (1, "Wide")}


def test_both_plans_keep_duplicate_and_unreadable_hosts(spark, monkeypatch):
    blocks = _blocks(spark, [("10.0.0.0/8", 1, "Wide"), ("10.1.0.0/16", 99, None)])
    rows = [("10.1.0.1",)] * 3 + [("10.2.0.1",)] * 2 + [(None,)] * 2 + [("300.1.1.1",), ("1.1.1.1",)]
    hosts = spark.createDataFrame(rows, "host string")
    fast = sorted(map(str, G.geolocate_ip(hosts, blocks).collect()))
    monkeypatch.setattr(G, "MAX_BROADCAST_BLOCKS", 0)
    assert sorted(map(str, G.geolocate_ip(hosts, blocks).collect())) == fast and len(fast) == len(rows)
    assert sum("geoname_id=99, country_name=None" in r for r in fast) == 3


def test_unlisted_nested_place_hides_the_wider_block(spark):
    blocks = spark.createDataFrame([("10.0.0.0/8", 1), ("10.1.0.0/16", 99)], "network string, geoname_id int")
    places = spark.createDataFrame([(1, "One")], "geoname_id int, country_name string")
    hosts = spark.createDataFrame([("10.1.2.3",), ("10.2.0.1",)], "host string")
    got = {r.host: (r.geoname_id, r.country_name)
           for r in G.geolocate_ip(hosts, G.blocks_with_country(blocks, places)).collect()}
    assert got == {"10.1.2.3": (99, None), "10.2.0.1": (1, "One")}


def test_registered_address_function_checks_octets(spark):
    from quillspark.functions.registry import register_functions
    register_functions(spark)
    got = spark.sql("SELECT ip, ip_to_long(ip) AS n FROM VALUES ('1.2.3.4'), ('300.1.1.1'), ('-1.0.0.0'), "
                    "('1.2.3'), ('1.2.3.4.5'), ('a.b.c.d') AS t(ip)").collect()
    assert {r.ip: r.n for r in got if r.n is not None} == {"1.2.3.4": 16909060}


def test_network_without_a_prefix_is_one_address(spark):
    blocks = _blocks(spark, [("10.0.0.0/8", 1, "Wide"), ("10.1.2.3", 2, "Single")])
    hosts = spark.createDataFrame([("10.1.2.3",), ("10.1.2.4",)], "host string")
    assert {r.host: r.country_name for r in G.geolocate_ip(hosts, blocks).collect()} == {
        "10.1.2.3": "Single", "10.1.2.4": "Wide"}


# ---- the merge over address ranges ---------------------------------------------------------------
def _dotted(v):
    return ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))


def _longest(blocks, ip):
    """The place of the longest prefix that holds the address, by trying all blocks."""
    found = max(((p, -g) for s, p, g in blocks if s <= ip < s + (1 << (32 - p))), default=None)
    return None if found is None else -found[1]


def _nested_blocks(n, seed=0):
    """Distinct nested blocks, a /0 block among them."""
    import random
    rng = random.Random(seed)
    out = {(0, 0): 1}
    for i in range(n):
        p = rng.choice([1, 7, 8, 12, 16, 20, 24, 28, 31, 32])
        base = rng.choice([rng.getrandbits(32), 0x0A000000 + rng.getrandbits(20)])
        out[(base >> (32 - p)) << (32 - p), p] = i + 2
    return [(s, p, g) for (s, p), g in out.items()]


def test_flattened_blocks_name_the_innermost_one():
    import numpy as np
    blocks = sorted(_nested_blocks(300))
    firsts, answers = G.flatten_blocks(np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks]))
    assert (np.diff(firsts) > 0).all()
    probes = sorted({v for s, p, _ in blocks for v in (s, s - 1, s + (1 << (32 - p)), s + (1 << (32 - p)) - 1) if 0 <= v < 1 << 32})
    for ip in probes:
        i = int(np.searchsorted(firsts, ip, "right")) - 1
        got = None if i < 0 or answers[i] < 0 else blocks[answers[i]][2]
        assert got == _longest(blocks, ip)
    assert [len(a) for a in G.flatten_blocks(np.array([], np.int64), np.array([], np.int64))] == [0, 0]


def test_merge_over_many_ranges_equals_trying_all_blocks(spark):
    import random
    rng = random.Random(1)
    blocks = _nested_blocks(200, 2)[1:]                # without /0: gaps exist
    ips = sorted({rng.choice(blocks)[0] + rng.randrange(300) for _ in range(800)} | {rng.getrandbits(32) for _ in range(300)})
    ips = [i for i in ips if i < 1 << 32]
    b = spark.createDataFrame([(s, p, g, f"c{g}" if g % 5 else None) for s, p, g in blocks],
                              "start long, plen int, geoname_id int, country_name string").repartition(3)
    a = spark.createDataFrame([(i,) for i in ips], "_ip long").repartition(4)
    for ranges in (1, 9, 40):
        got = {r["_ip"]: (r.geoname_id, r.country_name) for r in G.merge_blocks(a, b, ranges).collect()}
        want = {ip: g for ip in ips if (g := _longest(blocks, ip)) is not None}
        assert got == {ip: (g, f"c{g}" if g % 5 else None) for ip, g in want.items()}


def test_ranges_are_even_with_a_block_over_all_addresses(spark):
    """A /0 block is one row a range; addresses crowded into one /16 are spread like any others."""
    from pyspark.sql import functions as F
    crowded = spark.range(40_000).select((F.lit(0x0A010000) + F.col("id") % 65536).alias("_ip")).distinct()
    spread = spark.range(4_000).select((F.col("id") * 1_073_741 % 4294967296).alias("_ip")).distinct()
    both = crowded.unionAll(spread).distinct()
    blocks = spark.createDataFrame(_nested_blocks(100), "start long, plen int, geoname_id int") \
        .withColumn("country_name", F.lit("x"))
    bounds = G.address_ranges(both, blocks, 10)
    ips = sorted(r["_ip"] for r in both.collect())
    import bisect
    sizes = [bisect.bisect_left(ips, hi) - bisect.bisect_left(ips, lo) for lo, hi in zip(bounds, [*bounds[1:], 1 << 32])]
    assert sum(sizes) == len(ips) and max(sizes) <= 2 * len(ips) / len(sizes)
    assert G.merge_blocks(both, blocks, 10).count() == len(ips)  # the /0 block places everything


def test_merged_plan_equals_broadcast_plan_on_nested_and_unlisted_blocks(spark, monkeypatch):
    import random
    rng = random.Random(5)
    nested = _nested_blocks(60, 6)
    rows = [(f"{_dotted(s)}/{p}", g, f"c{g}" if g % 4 else None) for s, p, g in nested]
    rows += [(n, g + 1000, "duplicate") for n, g, _ in rows[:20]] + [("bad/8", 3, "x"), (None, 4, "y")]
    blocks = _blocks(spark, rows)
    hosts = [(_dotted(min(rng.choice(nested)[0] + rng.randrange(50), (1 << 32) - 1)),) for _ in range(300)] + [(None,), ("1.2.3",)]
    df = spark.createDataFrame(hosts, "host string")
    fast = sorted(map(str, G.geolocate_ip(df, blocks).collect()))
    monkeypatch.setattr(G, "MAX_BROADCAST_BYTES", 1)  # the bytes alone decide
    assert sorted(map(str, G.geolocate_ip(df, blocks).collect())) == fast and len(fast) == len(hosts)


def test_no_blocks_at_all(spark, monkeypatch):
    monkeypatch.setattr(G, "MAX_BROADCAST_BLOCKS", -1)
    hosts = spark.createDataFrame([("10.1.2.3",)], "host string")
    r = G.geolocate_ip(hosts, _blocks(spark, [("10.1.0.0/16", 2, "Mid")]).limit(0)).collect()
    assert [tuple(x) for x in r] == [("10.1.2.3", None, None)]
