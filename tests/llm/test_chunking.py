import hashlib
import random

import pytest

from quillspark.llm import chunking as C

SF = "/root/testdata/sf0.01"


def slow_boundaries(data):
    ends, start = [], 0
    mask = 0xFFFFFFFF
    gear = [0] * (len(data) + 1)
    for i, b in enumerate(data):  # the hash of the last 32 bytes
        gear[i + 1] = ((gear[i] << 1) + int(C.GEAR[b])) & mask
    while start < len(data):
        end = None
        for e in range(start + C.LEAST, min(start + C.MOST, len(data)) + 1):
            if gear[e] & int(C.STRICT if e <= start + C.WANTED else C.EASY) == 0:
                end = e
                break
        start = end or min(start + C.MOST, len(data))
        ends.append(start)
    return ends


@pytest.mark.parametrize("size", [0, 1, 11, 12, 40, 5000])
def test_boundaries_match_the_rule(size, monkeypatch):
    data = random.Random(size).randbytes(size)
    want = slow_boundaries(data)
    assert C.boundaries(data) == want
    monkeypatch.setattr(C, "BLOCK", 64)
    assert C.boundaries(data) == want


def test_shift_resistance():
    data = random.Random(3).randbytes(20_000)
    a, b = C.chunks(data), C.chunks(b"inserted" + data[:9000] + b"!" + data[9000:])
    assert C.containment(a, b) > 0.98


def brute(docs):
    order = sorted(docs, reverse=True)
    out = {}
    for d, nxt in zip(order, order[1:] + order[:1]):
        t, f = docs[d] or "", docs[nxt] or ""
        n = len(t) // 3
        edited = (t[:len(t) - n] + f[:n]).encode()
        out[d] = (len(t), hashlib.sha256(edited).hexdigest(), C.fingerprint(C.chunks(t.encode())),
                  C.fingerprint(C.chunks(edited)), C.containment(C.chunks(t.encode()), C.chunks(edited)),
                  C.containment(C.chunks(t.encode()), C.chunks(f.encode())))
    return out


def test_query_matches_brute_force(spark, sf_docs):
    from quillspark.llm.queries import queries
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op5_fingerprint"](spark, SF).collect()}
    assert got == brute(sf_docs)
    longer = [v for v in got.values() if v[0] > 300]
    assert sum(v[4] > 0.5 for v in longer) > 0.97 * len(longer)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_ranges(docs_of, parts):
    rng = random.Random(parts)
    docs = {rng.randint(-10**15, 10**15): rng.choice([None, "", "é" * 9, "word " * rng.randint(1, 90)]) for _ in range(60)}
    got = {r.doc_id: tuple(r)[1:] for r in C.fingerprint_documents(docs_of(list(docs.items())), parts).collect()}
    assert got == brute(docs)


def test_edges(docs_of):
    rows = [(2, "b" * 60), (2, "b" * 60), (None, "c" * 60), (1, "a" * 60)]
    got = C.fingerprint_documents(docs_of(rows), 3).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "None"]
    one = C.fingerprint_documents(docs_of([(7, "abc")]), 4).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert C.fingerprint_documents(docs_of(rows).filter("false")).count() == 0
