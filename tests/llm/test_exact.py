import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import exact as X

KEEP = bytes(c for c in range(256) if c not in b" \t\n\x0b\x0c\r")


def slow_groups(rows):
    """rows (doc_id, text) -> sorted rows of the operator, by dictionaries."""
    groups = {}
    for d, t in rows:
        groups.setdefault(bytes(c for c in (t or "").encode() if c in KEEP), []).append((d, len(t or "")))
    out = []
    for text, members in groups.items():
        order = sorted(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        for i, (d, _) in enumerate(order):
            out.append((d, order[0][0], len(order), i == 0, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abc  \n") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    out = [(i, rng.choice(base)) for i in range(200)]
    out += [(1000 + i, "the hot text " + " " * (i % 7)) for i in range(150)]
    out += [(None, base[3]), (None, base[3] + " "), (None, "only null ids"), (None, "only null ids"), (7, base[5]), (7, base[5]),
            (2000, None), (2001, ""), (2002, "\t\v\f\r\n "), (2003, " "), (2004, "long " * 60_000), (2005, "long" * 60_000),
            (2006, "é é"), (2007, "éé")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"remembered": 1}, {"bucket_entries": 3, "bucket_bytes": 200},
                                     {"key_of": lambda t: -1}, {"key_of": lambda t: len(t) % 3 - 1, "remembered": 400}])
def test_equals_brute_force(spark, docs_of, rows, options):
    got = found(X.exact_groups(docs_of(rows, 5), **options))
    assert got == slow_groups(rows)


def test_one_row_of_a_group_stays_with_all_its_columns(docs_of, rows):
    docs = docs_of(rows)
    kept = X.keep_one_copy(docs)
    assert kept.columns == docs.columns
    want = sorted((d for d, _, _, k, _ in slow_groups(rows) if k), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want
    assert {r.fp for r in kept.collect()} == {"x"}


def test_empty_table(docs_of):
    assert X.exact_groups(docs_of([(1, "a")]).limit(0)).count() == 0
    assert X.keep_one_copy(docs_of([(1, "a")]).limit(0)).count() == 0


def test_invalid_utf8_is_compared_by_its_bytes(spark):
    df = spark.createDataFrame([(1, bytearray(b"a\xffb")), (2, bytearray(b"a \xffb")), (3, bytearray(b"a\xfeb"))], "doc_id long, b binary")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in X.exact_groups(df.select("doc_id", F.col("b").cast("string").alias("text"))).collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (3, 1)}


def _entries(spark, keys):
    return spark.createDataFrame([(k, 10) for k in keys], "key long, size long")


def test_directory_splits_overfull_buckets_and_covers_all_keys(spark):
    rng = random.Random(1)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)]
    d = X.grow_directory(_entries(spark, keys), 1 << 30, 100)
    slots = dict(d.slots())
    assert sorted(slots) == list(range(1 << d.depth))
    load = {}
    for k in keys:
        b = slots[(k % (1 << 64)) >> (64 - d.depth)]
        load[b] = load.get(b, 0) + 1
    assert max(load.values()) <= 101 and len(d.leaves) < 80  # the capacity and one key


def test_directory_counts_crowded_prefixes_by_finer_bits(spark):
    crowded = [(5 << 55) + i * (1 << 40) for i in range(500)]
    spread = [((i * 0x9E3779B97F4A7C15) % (1 << 64)) - (1 << 63) for i in range(500)]
    d = X.grow_directory(_entries(spark, crowded + spread), 1 << 30, 100, max_depth=30)
    load = {}
    for k in crowded + spread:
        leaf = next(x for x in d.leaves if (k % (1 << 64)) >> (64 - x[1]) == x[0]) if d.depth else d.leaves[0]
        load[leaf] = load.get(leaf, 0) + 1
    assert max(load.values()) <= 101 and d.depth > 10
    assert max(dep for _, dep in X.grow_directory(_entries(spark, crowded), 1 << 30, 100, max_depth=6).leaves) <= 6


def test_a_hot_key_does_not_deepen_the_directory(spark):
    keys = [12345] * 5000 + list(range(-50, 0))
    d = X.grow_directory(_entries(spark, keys), 1 << 30, 100)
    assert d.depth <= 2
