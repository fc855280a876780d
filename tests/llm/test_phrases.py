import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import phrases as P

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
        yield re.findall(r"[^\x20\x09]+", piece)


def slow_counts(rows, max_words=4):
    f = Counter()
    for lang, text in rows:
        for w in pieces(text):
            for k in range(1, max_words + 1):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def slow_phrases(rows, min_count, max_words=4, top=None):
    f = slow_counts(rows, max_words)
    n = Counter()
    for (lang, *w), c in f.items():
        n[lang] += c * (len(w) == 1)
    cand = {p: c for p, c in f.items() if len(p) > 2 and c >= min_count}
    hidden = set()
    for (lang, *w), c in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inner = (lang, *w[i:i + size])
                if 100 * c >= 80 * f[inner]:
                    hidden.add(inner)
    found = {}
    for (lang, *w), a in cand.items():
        if (lang, *w) in hidden:
            continue
        cuts = [(2_000_000 * a // (f[(lang, *w[:i])] + f[(lang, *w[i:])]), i) for i in range(1, len(w))]
        score, i = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:i])], f[(lang, *w[i:])]))
    out = []
    for lang, x in found.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    import random
    rng = random.Random(7)
    words = ["the", "of", "Red", "fox", "over", "é", " x", "a-b", "SO", "jumps", "lazy", "dog"]
    out = []
    for i in range(150):
        t = []
        for _ in range(rng.randint(0, 60)):
            t.append(rng.choice(words[:rng.randint(2, 12)]) + rng.choice(["", "", "", ".", ",", " !", "\n", "\t", "\v", "?"]))
        out.append((rng.choice(["en", "en", "de", None]), " ".join(t)))
    out += [("en", "once upon a time") for _ in range(40)] + [("en", None), ("en", ""), (None, " . ,"), ("xx", "lonely")]
    return out


def frame(spark, rows):
    df = spark.createDataFrame([(i if i % 9 else None, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    for extra in ("k", "n", "phrase", "a", "rank", "words", "cut", "deal"):
        df = df.selectExpr("*", f"'x' AS {extra}")
    return df.repartition(3)


@pytest.mark.parametrize("options", [
    {"min_count": 5}, {"min_count": 30}, {"min_count": 5, "top": 3}, {"min_count": 5, "max_words": 2},
    {"min_count": 5, "sample": 1 << 30},  # nothing is proposed: the border fails at every length
    {"min_count": 5, "sample": 2, "proposed": 40}, {"min_count": 5, "sample": 1, "proposed": 1}])
def test_equals_brute_force(spark, rows, options):
    got = sorted(tuple(r) for r in P.mine_phrases(frame(spark, rows), **({"top": None} | options)).collect())
    want = slow_phrases(rows, options["min_count"], options.get("max_words", 4), options.get("top"))
    assert got == want and len(got) > (1 if options["min_count"] == 30 else 5)


def test_empty_table(spark, rows):
    assert P.mine_phrases(frame(spark, rows).limit(0)).count() == 0


def test_text_that_is_not_utf8_counts_as_replacement_characters(spark):
    df = spark.createDataFrame([(i, bytearray(b"a\xffb cd"), "en") for i in range(6)], "doc_id long, b binary, lang string")
    got = P.mine_phrases(df.selectExpr("doc_id", "CAST(b AS STRING) AS text", "lang"), min_count=2).collect()
    assert [(r.phrase, r.a, r.n) for r in got] == [("a�b cd", 6, 12)]


def _counted(rows, monkeypatch, at_once, block):
    monkeypatch.setattr(P, "TEXT_AT_ONCE", at_once)
    monkeypatch.setattr(P, "BLOCK", block)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([i % 2 == 0 for i in range(len(rows))]),
                                        pa.array([(r[1] or "").encode() for r in rows], pa.binary())], names=["lang", "sampled", "text"])
    tokens = [b.select(["lang", "carried", "ids", "words", "hashes"]) for b in P._tokenise(4)([batch])]
    out, total = Counter(), Counter()
    for b in P._count(4, None, None)(tokens):
        for lang, k, phrase, n in zip(*(c.to_pylist() for c in b.columns)):
            if k:
                out[(lang, *phrase.split(" "))] += n
            else:
                total[lang] += n
    return out, total, len(tokens)


@pytest.mark.parametrize("at_once,block", [(1 << 20, 1 << 20), (30, 50), (1, 1), (100, 200)])
def test_pieces_that_go_on_are_counted_once(rows, monkeypatch, at_once, block):
    more = rows + [("en", "w x y z " * 40), ("en", "v" * 300 + " u"), ("fr", "a b c d e f g")]
    got, total, n = _counted(more, monkeypatch, at_once, block)
    want = slow_counts(more)
    assert got == want and n > (1 if at_once > 1000 else 40)
    assert {lang: n for lang, n in total.items() if n} == {lang: sum(c for p, c in want.items() if p[0] == lang and len(p) == 2)
                                                            for lang in {p[0] for p in want}}


def test_bit_table_holds_every_phrase_and_little_else(spark):
    few = spark.createDataFrame([("en", f"w{i} w{i + 1}") for i in range(500)] + [("de", f"w{i}") for i in range(500)], "lang string, phrase string")
    table = P._bits_of(few, 19)
    assert len(table) == 1 << 13 and np.bitwise_count(table).sum() > 990
    sent = spark.sparkContext.broadcast(table)
    assert P._outside(few, sent).count() == 0
    other = spark.createDataFrame([("en", f"v{i} w{i}") for i in range(2000)], "lang string, phrase string")
    assert P._outside(other, sent).count() > 1900


def _numbered_rows(rows, monkeypatch, at_once=200, block=100):
    monkeypatch.setattr(P, "TEXT_AT_ONCE", at_once)
    monkeypatch.setattr(P, "BLOCK", block)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([False] * len(rows)),
                                        pa.array([(r[1] or "").encode() for r in rows], pa.binary())], names=["lang", "sampled", "text"])
    return list(P._tokenise(4)([batch]))


def test_numbers_and_words_of_a_text():
    text = b" a  b.a c.."
    ids, words = P.numbered(text)
    assert [P.STOP if i == P.STOP else words[i - 1] for i in ids.tolist()] == [b"a", b"b", P.STOP, b"a", b"c", P.STOP, P.STOP]
    for empty in (b"", b"  "):
        assert [len(x) for x in P.numbered(empty)] == [0, 0]
    assert P.numbered(b"..")[0].tolist() == [P.STOP, P.STOP] and P.numbered(b"..")[1] == []


@pytest.mark.parametrize("stretch,held", [(1, 1), (3, 7), (64, 500), (1 << 15, 1 << 20)])
def test_stretches_and_held_phrases_change_no_count(rows, monkeypatch, stretch, held):
    monkeypatch.setattr(P, "STRETCH", stretch)
    monkeypatch.setattr(P, "HELD", held)
    got, _, _ = _counted(rows + [("en", "w x y z " * 40)], monkeypatch, 4000, 300)
    assert got == slow_counts(rows + [("en", "w x y z " * 40)])


def test_hashes_that_meet_are_told_apart_by_their_words():
    ids = np.array([1, 2, 0, 1, 2, 0, 2, 1, 0, 3, 3, 1, 2], np.int32)
    at = np.array([0, 3, 6, 9, 10, 11])
    for k in (1, 2):
        place, n = P._unique(ids, at, np.zeros(len(at), np.uint64), k)
        got = {tuple(ids[p:p + k].tolist()): c for p, c in zip(place.tolist(), n.tolist())}
        assert got == dict(Counter(tuple(ids[p:p + k].tolist()) for p in at.tolist()))


@pytest.mark.parametrize("least", [1, 2, 5, 300, 1 << 40])
def test_tally_holds_every_hash_that_occurs_often_enough(spark, rows, monkeypatch, least):
    monkeypatch.setattr(P, "MIN_BITS", 24)
    tokens = spark.createDataFrame(pa.Table.from_batches(_numbered_rows(rows, monkeypatch)).to_pandas(), P._TOKENS).repartition(3)
    table, n = P._reaching(tokens, 4, least)
    counts = slow_counts(rows)
    often = [p for p, c in counts.items() if c >= least]
    by_hash = lambda ps: [int(P._phrase_hashes(pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in ps]), pa.array([" ".join(p[1:]) for p in ps])], names=["lang", "phrase"]))[i]) for i in range(len(ps))] if ps else []
    bits = P.Bits(table)
    assert bits.has(np.array(by_hash(often), np.uint64)).all()
    assert n == len(often) and len(table) * 64 == 1 << 24
    assert np.bitwise_count(table).sum() == len({h >> 40 for h in by_hash(often)})


def test_phrases_that_are_too_rare_leave_no_row(rows, monkeypatch):
    """The texts of rare phrases are never moved: a pass emits those that the tally names."""
    more = rows + [("en", " ".join(f"once{i}" for i in range(3000)))]
    class Sent:
        value = np.full((1 << 20) // 64, ~np.uint64(0))
    class Often:
        value = np.zeros((1 << 20) // 64, np.uint64)
    counts = slow_counts(more)
    often = {p for p, c in counts.items() if c >= 20}
    for lang, *w in often:
        h = int(P._phrase_hashes(pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([" ".join(w)])], names=["lang", "phrase"]))[0]) >> 44
        Often.value[h >> 6] |= np.uint64(1 << (h & 63))
    tokens = [b.select(["lang", "carried", "ids", "words", "hashes"]) for b in _numbered_rows(more, monkeypatch, 20_000, 20_000)]
    got, moved = Counter(), 0
    for b in P._count(4, Sent, None, Often)(tokens):
        for lang, k, phrase, n in zip(*(c.to_pylist() for c in b.columns)):
            moved += k > 0
            if k:
                got[(lang, *phrase.split(" "))] += n
    assert often <= set(got) and all(counts[p] == n for p, n in got.items())
    assert moved < len(often) * len(tokens) + 500 < 12_000
