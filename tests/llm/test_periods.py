import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quillspark.llm import periods as P
from quillspark.llm.queries import queries

SF = "/root/testdata/sf0.01"


def slow_runs(words, min_words=24, min_periods=3):
    """Every lag, every stretch of matches; a stretch that a smaller period fills as well goes."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a, found = np.array([number[w] for w in words]), {}
    for q in range(1, len(a) // min_periods + 1):
        same = np.concatenate(([False], a[q:] == a[:-q], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if j - i + q >= max(min_words, min_periods * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def slow_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = slow_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, sf_docs):
    got = sorted(tuple(r) for r in queries()["op11_periodic_runs"](spark, SF).collect())
    assert got == sorted(slow_row(d, t) for d, t in sf_docs.items())
    assert sum(r[1] > 0 for r in got) > 50


@pytest.mark.parametrize("min_words,min_periods", [(24, 3), (6, 3), (1, 3), (9, 4), (40, 5)])
def test_runs_equal_brute_force_on_repetitive_words(min_words, min_periods):
    rng = np.random.default_rng(min_words)
    texts = []
    for n in range(0, 260, 5):
        letters = rng.integers(0, rng.integers(1, 4), n)
        if n > 60:  # nested and touching runs
            p = int(rng.integers(2, 20))
            letters[10:10 + 4 * p] = np.resize(letters[10:10 + p], len(letters[10:10 + 4 * p]))
        texts.append(letters)
    got = P.runs_of_texts(texts, min_words, min_periods)
    assert got == [slow_runs(t.tolist(), min_words, min_periods) for t in texts]
    assert sum(map(len, got)) > 5


def test_periods_beyond_the_first_reach():
    rng = np.random.default_rng(5)
    for q in (15, 16, 17, 31, 32, 33, 64, 100):
        root = rng.integers(0, 50, q)
        text = np.concatenate([rng.integers(50, 90, 7), np.resize(root, 3 * q + 1), rng.integers(50, 90, 9)])
        assert (7, 3 * q + 1, q) in P.runs_of_texts([text])[0]
        short = np.concatenate([rng.integers(50, 90, 7), np.resize(root, 3 * q - 1), [99]])
        assert P.runs_of_texts([short])[0] == []


def test_equal_texts_side_by_side_are_not_one_text():
    text = np.arange(12)
    assert P.runs_of_texts([text] * 6) == [[]] * 6


def test_one_word_repeated_is_one_run_with_few_occurrences():
    words = np.zeros(200_000, np.int64)
    found = list(P.earlier_occurrences(words, 24, 3))
    assert len(found) <= len(words)
    assert P.runs_of_texts([words]) == [[(0, 200_000, 1)]]


def test_blocks_cut_no_word():
    text = b"  alpha beta\tgamma\n\ndelta " * 50
    assert [w for b in P.word_blocks(text, 7) for w in b] == text.split()
    runs = P.runs_of_texts([np.arange(200) % 4])[0]
    whole = P.collapse(text, runs, 200)
    assert whole == b"alpha beta gamma delta"


def test_edge_cases(spark, docs_of):
    long = " ".join(f"w{i % 40_000}" for i in range(130_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "ha " * 30), (4, "ha " * 30), (5, "a b " * 11), (None, "x y z " * 9),
            (7, long), (8, "ä ö " * 24)]
    out = P.collapse_periodic_runs(docs_of(rows)).collect()
    assert len(out) == len(rows)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out), key=str)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 30, [(0, 30, 1)], "ha"), (4, 30, [(0, 30, 1)], "ha"),
        (5, 22, [], ("a b " * 11).strip()), (None, 27, [(0, 27, 3)], "x y z"),
        (7, 130_000, [(0, 130_000, 40_000)], " ".join(f"w{i}" for i in range(40_000))),
        (8, 24, [(0, 24, 1)], "ä ö")], key=str)
    assert P.collapse_periodic_runs(docs_of(rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.collapse_periodic_runs(docs_of(rows), min_periods=2)


def test_planting_and_summary_on_nulls(spark, docs_of):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    text = " ".join(f"w{i}" for i in range(97))
    rows = [(i, text) for i in ids] + [(None, text), (ids[0], None), (ids[1], " ")]
    got = {(r.doc_id, r.text) for r in P.plant_runs(docs_of(rows)).collect()}
    want = {(i, " ".join(planted(i, text.split()))) for i in ids}
    assert got == want | {(None, text), (ids[0], None), (ids[1], " ")}
    df = spark.createDataFrame([([(0, 30, 10), (5, 24, 8), (60, 90, 30)],), ([],)],
                               "runs array<struct<start: long, length: long, period: long>>")
    best = [r.b for r in df.select(P.strongest_run("runs").alias("b")).collect()]
    assert tuple(best[0]) == (0, 30, 10) and best[1] is None
