import random

import numpy as np
import pytest

from quillspark.llm import toxicity as T
from quillspark.llm.queries import queries

SF = "/root/testdata/sf0.1"


def made(n, seed=1, share=0.2):
    """Random prose; toxic texts hold a few words that no other text has."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(500)]
    rows, labels = [], []
    for d in range(n):
        text = rng.choices(words, k=rng.randint(20, 200))
        toxic = rng.random() < share
        for _ in range(rng.randint(2, 6) if toxic else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(["vile", "Rotten.", "foul-mouthed"]))
        rows.append((d, " ".join(text)))
        labels.append((d, int(toxic)))
    return rows, labels


def test_held_out_accuracy_on_the_table(spark):
    out = queries()["op3_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    held = out.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").toPandas()
    pos, neg = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert np.mean(pos[:, None] > neg[None, :]) + 0.5 * np.mean(pos[:, None] == neg[None, :]) > 0.95
    assert held[held.toxic == 1].predicted.mean() > 0.85 and held[held.toxic == 0].predicted.mean() < 0.02


def test_learns_from_texts_only(spark, docs_of):
    rows, labels = made(600)
    docs = docs_of(rows)
    train = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in T.score_toxicity(docs, train).collect()}
    test = [(got[d], y) for d, y in labels if d % 3 == 0]
    assert sum(p == y for p, y in test) > 0.97 * len(test)
    kept = {r.doc_id for r in T.drop_toxic(docs, train).collect()}
    assert kept == {d for d, p in got.items() if not p}


def test_kept_expressions_follow_the_formula(spark, docs_of):
    rows, labels = made(400, seed=2)
    m = T.fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    own = {w: m.word[m.index[T._word(w)]] for w in ("vile", "rotten") if T._word(w) in m.index}
    assert set(own) == {"vile", "rotten"} and min(own.values()) > 1
    assert (np.abs(m.word[m.word != 0]) >= 1).all() and len(m.word) < 60


@pytest.mark.parametrize("x,y,between", [([0, 0, .1, .5], [0, 0, 1, 1], (0, .1)), ([0, .2, .3, .9], [0, 1, 0, 1], (.3, .9))])
def test_threshold(x, y, between):
    m = T.Model([], [])
    m.calibrate(np.array(x, float), np.array(y, float), np.where(np.array(y) == 1, 1.0, 3.0))
    assert between[0] < m.threshold < between[1]
    assert m.score(between[0]) < 0.5 < m.score(between[1])


def test_edges(spark, docs_of):
    rows, labels = made(300, seed=3)
    extra = [(1000, None), (1001, ""), (None, "vile rotten vile"), (None, "calm")]
    docs = docs_of(rows + extra + [rows[0]])
    train = spark.createDataFrame(labels + [(None, 1), (5, None), (7, 1)], "doc_id long, toxic int")
    got = T.score_toxicity(docs, train).collect()
    assert len(got) == 305
    empty = [r for r in got if r.doc_id in (1000, 1001)]
    assert [r.predicted for r in empty] == [0, 0] and all(0 <= r.score <= 1 for r in got)
    none = T.score_toxicity(docs, train.filter("false")).collect()
    assert {r.score for r in none} == {0.0}
    assert {r.score for r in T.score_toxicity(docs, train.filter("toxic = 1")).collect()} == {1.0}
    assert T.score_toxicity(docs.filter("false"), train).count() == 0


def test_corpus_counts_cover_every_word_and_stem(docs_of):
    rows = [(1, "Alphabet alphas alpha, b"), (2, None), (3, "alpha b b alphabets"), (4, "")]
    got = {r.w: r.n for r in T.corpus_counts(docs_of(rows)).collect()}
    want = {"alphabet": 1, "alphas": 1, "alpha": 2, "b": 3, "alphabets": 1, "alpha*": 3, "alph*": 5}
    assert got == {T._digest(k): n for k, n in want.items()}


def test_expressions_need_more_letters_than_their_stem():
    assert T._stem(5)("alpha") == T.START and T._stem(4)("alpha") == T._digest("alph*")


def test_a_phrase_whose_word_follows_one_word_only_is_learnt(spark, docs_of):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(500)]
    rows, labels = [], []
    for d in range(500):
        text = rng.choices(words, k=rng.randint(30, 100)) + ["such"]
        rng.shuffle(text)
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(2, 5) if toxic else 0):
            at = text.index("such")
            text[at:at] = rng.choices(words, k=2) + ["such", "vermin"] + rng.choices(words, k=2)
        rows.append((d, " ".join(text)))
        labels.append((d, toxic))
    train = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, toxic int")
    docs = docs_of(rows)
    m = T.fit(docs, train)
    such, vermin = (m.index[T._word(w)] for w in ("such", "vermin"))
    assert such * m.size + vermin in m.pair_keys.tolist() and m.word[vermin] == 0
    got = {r.doc_id: r.predicted for r in T.score_toxicity(docs, train).collect()}
    test = [(got[d], y) for d, y in labels if d % 3 == 0]
    assert sum(p == y for p, y in test) > 0.95 * len(test)


# ---- a plain Kneser-Ney -----------------------------------------------------------------------------
def plain_model(texts, sample, s=T.Settings()):
    """({expression: log ratio}, {(v, w): log ratio}) by dictionaries. ``sample``: (id, toxic) of
    the counted rows; ``texts``: {id: text} of the corpus."""
    import math
    levels = (T._word, T._stem(5), T._stem(4))
    forms = lambda raw: [e for e in (of(T._plain(raw)) for of in levels) if e != T.START]
    pairs, held_by, corpus = [set(), set()], [{}, {}], {}
    for t in texts.values():
        for raw in (t or "").encode().split():
            for e in forms(raw):
                corpus[e] = corpus.get(e, 0) + 1
    for d, toxic in sample:
        words = texts[d].encode().split()
        before = [T.START] + [T._word(T._plain(w)) for w in words]
        pairs[toxic] |= {(v, e) for v, w in zip(before, words) for e in forms(w)}
    for toxic in (0, 1):
        for text in {texts[d] for d, y in sample if y == toxic}:
            for e in {T._word(T._plain(w)) for w in text.encode().split()}:
                held_by[toxic][e] = held_by[toxic].get(e, 0) + 1
    c = {}
    for toxic in (0, 1):
        for _, e in pairs[toxic]:
            c.setdefault(e, [0, 0])[toxic] += 1
    cut = lambda n: max(n - s.discount, 0.0)
    total = [sum(x[y] for x in c.values()) for y in (0, 1)]
    rest = [1 - sum(cut(x[y]) for x in c.values()) / total[y] for y in (0, 1)]
    base, share = math.log(rest[1] / rest[0]), total[1] / sum(total)
    mass = sum(corpus.values()) + len(corpus) + 1

    def differs(o, t):
        g = sum(n * math.log(n / ((o + t) * q)) for n, q in ((t, share), (o, 1 - share)) if n)
        return 2 * g >= s.significance * math.log(len(corpus) + 1)

    p, words = {}, {}
    for e, (o, t) in c.items():
        often = max(o, t) >= s.min_count
        if often or max(held_by[0].get(e, 0), held_by[1].get(e, 0)) >= s.min_count:
            shared = (corpus.get(e, 0) + 1) / mass
            p[e] = [cut(n) / total[y] + rest[y] * shared for y, n in ((0, o), (1, t))]
            ratio = math.log(p[e][1] / p[e][0]) - base
            if often and differs(o, t) and abs(ratio) >= s.min_log_ratio:
                words[e] = ratio
    triples = [set(), set()]
    for d, toxic in sample:
        x = [T.START, T.START] + [T._word(T._plain(w)) for w in texts[d].encode().split()]
        triples[toxic] |= {(a, v, w if w in p else T.RARE) for a, v, w in zip(x, x[1:], x[2:]) if v in p}
    two, head = {}, {}
    for toxic in (0, 1):
        for _, v, w in triples[toxic]:
            two.setdefault((v, w), [0, 0])[toxic] += 1
    for (v, _), n in two.items():
        h = head.setdefault(v, [0, 0, 0.0, 0.0])
        for y in (0, 1):
            h[y] += n[y]
            h[2 + y] += cut(n[y])
    found = {}
    for (v, w), n in two.items():
        if w != T.RARE and max(n) >= s.min_count and differs(*n):
            h = head[v]
            q = [cut(n[y]) / h[y] + (1 - h[2 + y] / h[y]) * p[w][y] if h[y] else p[w][y] for y in (0, 1)]
            ratio = math.log(q[1] / q[0]) - base
            if abs(ratio) >= s.min_log_ratio:
                found[v, w] = ratio
    return words, found


def plain_evidence(words, pairs, text):
    known = set(words) | {e for pair in pairs for e in pair}
    levels = (T._word, T._stem(5), T._stem(4))
    forms = [[of(T._plain(w)) for of in levels] for w in (text or "").encode().split()]
    own = [next((e for e in f if e in known), None) for f in forms]
    value = [words.get(e, 0.0) for e in own]
    for i in range(1, len(own)):
        value[i] = pairs.get((own[i - 1], own[i]), value[i])
    return sum(value) / len(value) if value else 0.0


def check_against_plain(spark, docs, texts, labels):
    sample = [(r.id, r.toxic) for r in T.labelled_sample(labels, T.Settings().max_docs).collect() if not r.held]
    words, pairs = plain_model(texts, [x for x in sample if x[0] in texts])
    m = T.fit(docs, labels)
    name = {i: d for d, i in m.index.items()}
    got_pairs = {(name[k // m.size], name[k % m.size]): x for k, x in zip(m.pair_keys.tolist(), m.pair_values.tolist())}
    assert set(got_pairs) == set(pairs) and {name[i] for i in np.flatnonzero(m.word)} == set(words)
    assert all(abs(got_pairs[k] - x) < 1e-9 for k, x in pairs.items())
    assert all(abs(m.word[m.index[w]] - x) < 1e-9 for w, x in words.items())
    scored = {r.doc_id: r.score for r in T.score_toxicity(docs, labels).collect()}
    for d, t in texts.items():
        assert abs(scored[d] - float(m.score(plain_evidence(words, pairs, t)))) < 1e-9
    return words, pairs


def test_every_score_equals_the_plain_models(spark, sf_docs):
    from quillspark.llm.common import documents
    from quillspark.llm.queries import training_labels
    sf = "/root/testdata/sf0.01"
    words, _ = check_against_plain(spark, documents(spark, sf), sf_docs, training_labels(spark, sf))
    assert words


def test_pairs_equal_the_plain_models(spark, docs_of):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(80)]
    rows, labels = [], []
    for d in range(500):
        text, toxic = rng.choices(words, k=rng.randint(20, 60)), int(rng.random() < 0.3)
        for _ in range(4 if toxic else 1):
            at = rng.randint(0, len(text))
            text[at:at] = ["such", "vermin"] if toxic else [rng.choice(["such", "vermin"])]
        rows.append((d, " ".join(text)))
        labels.append((d, toxic))
    _, pairs = check_against_plain(spark, docs_of(rows), dict(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert pairs


def test_expressions_over_the_bound_are_an_error(spark, docs_of):
    rows, labels = made(200, seed=4)
    with pytest.raises(ValueError, match="more than 5 expressions"):
        T.fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), T.Settings(max_entries=5))
