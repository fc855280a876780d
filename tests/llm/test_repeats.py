import random

import numpy as np
import pytest
from brute import bytes_result, words_result

from quillspark.llm import repeats as R
from quillspark.llm.substring import remove_repeated_words

SF = "/root/testdata/sf0.01"


def test_roll_is_the_plain_polynomial():
    h = np.random.default_rng(1).integers(0, 2**63, 400).astype(np.uint64)
    for n in (1, 2, 6, 20, 100):
        want = [sum(int(x) * pow(R._PRIME, n - 1 - j, 1 << 64) for j, x in enumerate(h[i:i + n])) % 2**64
                for i in range(len(h) - n + 1)]
        assert R.roll(h, n).tolist() == want


def test_equal_windows_have_their_anchor_at_the_same_offset():
    rng = np.random.default_rng(2)
    core = rng.integers(0, 2**63, 200).astype(np.uint64)
    places = []
    for pad in (0, 37, 501):
        h = np.concatenate([rng.integers(0, 2**63, pad).astype(np.uint64), core])
        at = {}
        for base, lo, hi, anchor, _, _ in R.runs(h, 20, 6, block=64):
            for a, b, c in zip(lo, hi, anchor):
                at.update({base + i - pad: base + c - pad - (base + i - pad) for i in range(a, b + 1)})
        assert len(at) == len(h) - 19
        places.append([at[i] for i in range(181)])
    assert places[0] == places[1] == places[2] and all(0 <= o <= 14 for o in places[0])


def mixed_docs(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(400)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(15, 60))) for _ in range(6)]
    docs = {}
    for d in rng.sample(range(1000), n):
        kind = rng.random()
        if kind < 0.1 and docs:
            t = docs[rng.choice(list(docs))]
        elif kind < 0.15:
            t = rng.choice(["", None, "short text", "a " * 300, "x" * 500])
        else:
            parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(3)]
            for _ in range(rng.randint(0, 3)):
                parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
            t = rng.choice([" ", "\n"]).join(parts)
            if rng.random() < 0.2 and docs:
                other = docs[rng.choice(list(docs))] or ""
                t += " " + other[len(other) // 3:]
        docs[d] = t
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_words_match_brute_force(docs_of, seed):
    docs = mixed_docs(seed)
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeated_words(docs_of(list(docs.items()))).collect()}
    assert got == words_result(docs)


def test_words_query_matches_brute_force(spark, sf_docs):
    from quillspark.llm.queries import queries
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op2_substring"](spark, SF).collect()}
    assert got == words_result(sf_docs)


def test_word_edges(docs_of):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (2, "few " * 5), (3, None), (3, "")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in remove_repeated_words(docs_of(rows)).collect())
    assert got == [("1", 30, 0), ("1", 30, 0), ("2", 5, 0), ("3", 0, 0), ("3", 0, 0), ("None", 30, 30)]
    assert remove_repeated_words(docs_of(rows).filter("false")).count() == 0


@pytest.mark.parametrize("seed,max_class", [(1, 200_000), (2, 2), (3, 1)])
def test_bytes_match_brute_force(docs_of, seed, max_class):
    from quillspark.llm import suffixes as S
    docs = mixed_docs(seed)
    got = {r.doc_id: tuple(r)[1:] for r in S.remove_repeated_bytes(docs_of(list(docs.items())), max_class=max_class).collect()}
    assert got == bytes_result(docs)


@pytest.mark.parametrize("pairwise,max_class", [(100, 10**6), (12, 10**6), (1, 10**6), (1, 3)])
def test_class_paths_agree(pairwise, max_class, monkeypatch):
    from quillspark.llm import suffixes as S
    monkeypatch.setattr(S, "PAIRWISE", pairwise)
    rng = random.Random(pairwise)
    seed = rng.randbytes(20)
    found = []
    for i in range(40):
        right = seed + bytes(rng.choices(b"ab", k=rng.randint(0, 6))) + b"z" * 60
        left = bytes(rng.choices(b"cd", k=rng.randint(0, 5))) + b"y" * 40
        right, left = right[:rng.randint(60, 86)], left[:rng.randint(40, 45)]
        found.append((right, left, rng.randint(0, 8), 1000 * i + 500))
    out = S.Spans()
    S.settle_class(list(found), 100, 20, out, max_class)
    got, ranked = set(), {}
    for digest, doc, ref, n, settled in zip(*out.rows):
        if settled:
            got |= {(doc, ref + k) for k in range(n)}
        else:
            ranked.setdefault(digest, []).append((doc, ref))
    for places in ranked.values():
        got |= {p for p in places if p > min(places)}
    windows = {}
    for right, left, doc, ref in found:
        text = left[::-1] + right
        for k in range(len(text) - 99):
            windows.setdefault(text[k:k + 100], []).append((doc, ref - len(left) + k))
    assert got == {p for places in windows.values() for p in places if p > min(places)}


def test_loser_tree_merges_with_common_prefixes():
    from quillspark.llm import suffixes as S
    rng = random.Random(5)
    for k in (1, 2, 3, 7, 8):
        runs = [sorted((bytes(rng.choices(b"ab", k=rng.randint(1, 9))), b"l" * rng.randint(0, 3), i, j) for j in range(rng.randint(0, 30)))
                for i in range(k)]
        read = [S.read_run(S.front_code(r, [(1, 2, 3)])) for r in runs]
        assert all(s.tolist() == [[1, 2, 3]] for _, s in read)
        out = list(S.merge_runs([r for r, _ in read]))
        assert [s[0] for _, s in out] == sorted(s[0] for r in runs for s in r)
        assert sorted(s for _, s in out) == sorted(s for r in runs for s in r)
        for (_, a), (p, b) in zip(out, out[1:]):
            assert p == S.common(a[0], b[0], 0)


def test_bytes_query_matches_brute_force(spark, sf_docs):
    from quillspark.llm.queries import queries
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op10_suffix_dedup"](spark, SF).collect()}
    assert got == bytes_result(sf_docs)


def test_byte_edges(docs_of):
    from quillspark.llm.suffixes import drop_repeated_text, remove_repeated_bytes
    text = "".join(f"é{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text + "tail"), (2, "few"), (3, None), (3, ""), (4, "z" * 250)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeated_bytes(docs_of(rows)).collect())
    n = len(text.encode())
    assert got == [("1", n, 0, 0), ("1", n, 0, 0), ("2", 3, 0, 0), ("3", 0, 0, 0), ("3", 0, 0, 0), ("4", 250, 249, 1),
                   ("None", n + 4, n, 1)]
    kept = {(r.doc_id, r.text, r.n_chars) for r in drop_repeated_text(docs_of(rows)).collect()}
    assert kept == {(1, text, len(text)), (2, "few", 3), (3, "", 0), (4, "z", 1), (None, "tail", 4)}
    assert remove_repeated_bytes(docs_of(rows).filter("false")).count() == 0


def test_long_texts_are_read_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 300)
    rng = np.random.default_rng(4)
    a = rng.integers(97, 105, 2500).astype(np.uint8).tobytes().decode()
    h = np.frombuffer(a.encode(), np.uint8).astype(np.uint64)
    starts = [base + i for base, lo, hi, *_ in R.runs(h, 100, 20, block=300) for l, u in zip(lo, hi) for i in range(l, u + 1)]
    assert starts == list(range(2401))


def boilerplate_docs(n, line=b"Licensed under terms that many share;"):
    """A line with other text around it in every document, and some passages that repeat whole."""
    rng = random.Random(n)
    filler = lambda k: "".join(rng.choices("abcdefghijklmnop ", k=k))
    passage = filler(150)
    return {d: filler(rng.randint(80, 200)) + line.decode() + filler(rng.randint(80, 200))
            + (passage if d % 7 == 0 else "") for d in range(n)}


def test_hot_prefixes_never_reach_the_merge(docs_of):
    from quillspark.llm import suffixes as S
    docs, most = boilerplate_docs(60), 10
    df = docs_of(list(docs.items()))
    wanted = S.repeated_anchors(df, 100, 20, most)
    hot = {r.hot for r in wanted.filter("hot is not null").collect()}
    texts = R.carriers(df, ["doc_id"])
    rows = S.sorted_runs(texts, wanted, [], 100, 20, hot).collect()
    classes = {}
    for _, s in S.merge_runs([S.read_run(r.run)[0] for r in rows if r.run is not None]):
        classes.setdefault(s[0][:20], []).append(s)
    assert hot and classes and max(map(len, classes.values())) <= most
    assert any(r.run is None for r in rows)
    got = {r.doc_id: tuple(r)[1:] for r in S.remove_repeated_bytes(df, max_class=most).collect()}
    assert got == bytes_result(docs)


def test_hot_chunks_are_ranked_together(docs_of):
    from quillspark.llm import suffixes as S
    docs = boilerplate_docs(40)
    docs.update({100 + d: docs[d] for d in range(20)})
    got = {r.doc_id: tuple(r)[1:] for r in S.remove_repeated_bytes(docs_of(list(docs.items()), 5), max_class=1).collect()}
    assert got == bytes_result(docs)


@pytest.mark.parametrize("max_class", [10**6, 50])
def test_a_large_class_stops_often(max_class):
    from quillspark.llm import suffixes as S
    rng = random.Random(3)
    found = [(b"s" * 90, b"t" * 40 + rng.randbytes(4), d, 1000) for d in range(200)]
    out, most, total = S.Spans(), 0, 0
    for _ in S.settle_steps(found, 100, 20, out, max_class):
        most, total = max(most, len(out)), total + len(out)
        out.batch()
    assert total > 4000 and most <= 200


@pytest.mark.parametrize("max_class", [10**6, 1])
def test_texts_that_share_a_place_all_lose_a_passage_of_an_earlier_document(docs_of, max_class):
    from quillspark.llm import suffixes as S
    rng = random.Random(8)
    filler = lambda k: "".join(rng.choices("abcdefghijklmnop ", k=k))
    passage = filler(300)
    rows = [(5, passage + filler(90)), (5, passage + filler(80)), (2, filler(70) + passage)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed >= 300) for r in
                 S.remove_repeated_bytes(docs_of(rows, 1), max_class=max_class).collect())
    assert got == [(2, 370, False), (5, 380, True), (5, 390, True)]
