import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillspark.llm.components import connected_components
from quillspark.llm.simhash import grid_blocks, keep_one_per_group, near_links, simhash_components

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    digests = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def slow_components(fps):
    """{id: smallest id reachable}, ids given with their fingerprints, by repeated sweeps."""
    ids = sorted(fps)
    v = np.array([fps[i] for i in ids], np.uint64)
    best = np.arange(len(ids))
    near = [np.flatnonzero(np.bitwise_count(v ^ x) <= 4) for x in v]
    changed = True
    while changed:
        changed = False
        for i, n in enumerate(near):
            m = best[n].min()
            if m < best[i]:
                best[i], changed = m, True
    return {i: ids[b] for i, b in zip(ids, best)}


def test_matches_brute_force_on_the_table(spark, sf_docs):
    from quillspark.llm.queries import queries
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries()["op1_simhash"](spark, SF).collect()}
    fps = {d: slow_fingerprint(t) for d, t in sf_docs.items()}
    comp = slow_components(fps)
    assert got == {d: (f"{fps[d]:016x}", comp[d]) for d in fps}


@pytest.mark.parametrize("n", [50, 3_000])
def test_grid_join_loses_no_link(spark, n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    flips = base.copy()
    for _ in range(4):
        flips ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    cluster = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    fps = np.unique(np.concatenate([base, flips, cluster]))
    df = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, rep long")
    comp = {r.node: r.component for r in connected_components(near_links(df, len(fps), 4)).collect()}
    want = slow_components(dict(enumerate(fps.tolist())))
    assert {i: comp.get(i, i) for i in want} == want


def test_more_fingerprints_get_finer_grids():
    assert [grid_blocks(n, 4) for n in (100, 10**6, 10**8)] == sorted(grid_blocks(n, 4) for n in (100, 10**6, 10**8))


def test_edges(spark, docs_of):
    rows = [(5, None), (3, ""), (9, "  \n"), (1, "One two three four five"), (8, "one TWO three four five"),
            (8, "one TWO three four five"), (None, "one two three four five"), (7, "word"), (None, "alone here")]
    out = simhash_components(docs_of(rows))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=str)
    zero = "0" * 16
    assert [g for g in got if g[1] == zero] == [(3, zero, 3), (5, zero, 3), (9, zero, 3)]
    assert {(d, c) for d, f, c in got if f != zero} == {(1, 1), (8, 1), (None, 1), (7, 7), (None, None)}
    kept = keep_one_per_group(docs_of(rows))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(["3", "1", "None", "7", "None"])
    assert "cell" in kept.columns
    assert simhash_components(docs_of(rows).filter("false")).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected_components(edges).collect()} == {0}


def test_repeated_ids_with_different_texts_lose_no_group(docs_of):
    """Ids that stand in several groups tie none together, and every group keeps one row."""
    a, b, c = "one two three four five six", "alpha beta gamma delta epsilon", "red green blue black white"
    rows = [(2, b), (5, a), (5, b), (9, a), (5, c), (9, c), (9, c), (9, b)]
    kept = sorted((r.doc_id, r.text) for r in keep_one_per_group(docs_of(rows)).collect())
    assert kept == sorted([(2, b), (5, a), (5, c)])
    comp = sorted((r.doc_id, r.component_id) for r in simhash_components(docs_of(rows)).collect())
    assert comp == sorted([(2, 2), (5, 5), (5, 2), (9, 5), (5, 5), (9, 5), (9, 5), (9, 2)])


def test_repeated_whole_rows_and_null_ids(docs_of):
    a, long = "one two three four five six", "w " * 200_000
    rows = [(3, a)] * 40 + [(None, a)] * 3 + [(None, None), (1, long), (7, long), (2, ""), (4, None)]
    kept = sorted(((r.doc_id, (r.text or "")[:3]) for r in keep_one_per_group(docs_of(rows)).collect()), key=str)
    assert kept == sorted([(3, "one")] + [(None, "one")] * 3 + [(None, ""), (1, "w w"), (2, "")], key=str)
    assert keep_one_per_group(docs_of(rows).filter("false")).count() == 0
