import numpy as np
import pytest
from brute import covered
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline as P
from quillspark.llm.common import documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = documents(spark, SF).select(*P.COLUMNS), []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stage_order_and_columns(outputs):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "mixing", "best_fit_packing"]
    for df in outputs[:-1]:
        assert df.columns == list(P.COLUMNS)


def test_toxic_documents_go_and_clean_ones_stay(outputs, spark, sf_docs):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    kept = set(texts(outputs[0]))
    clean = [d for d, y in zip(t["doc_id"], t["toxic"]) if not y]
    toxic = [d for d, y in zip(t["doc_id"], t["toxic"]) if y]
    assert sum(d in kept for d in clean) > 0.93 * len(clean)
    assert sum(d in kept for d in toxic) < 0.35 * len(toxic)


def test_one_document_of_each_group_stays(outputs):
    before = texts(outputs[0])
    groups = slow_components({d: slow_fingerprint(t) for d, t in before.items()})
    assert texts(outputs[1]) == {d: before[d] for d in set(groups.values())}


def test_repeated_text_is_cut(outputs):
    before = texts(outputs[1])
    want = {}
    for d, gone in covered({d: t.encode() for d, t in before.items()}, 100).items():
        at, out = 0, []
        for c in before[d]:
            n = len(c.encode())
            if not gone[at:at + n].all():
                out.append(c)
            at += n
        want[d] = "".join(out)
    assert texts(outputs[2]) == want


def test_mixing_moves_towards_the_weights(outputs):
    def share(df):
        rows = df.selectExpr("source", "char_length(text) n").groupBy("source").sum("n").collect()
        total = sum(r[1] for r in rows)
        return {r[0]: r[1] / total for r in rows}
    got = share(outputs[3])
    weight = {s: P.MIX_WEIGHTS.get(s, 1.0) for s in share(outputs[2])}
    far = max(abs(got[s] - w / sum(weight.values())) for s, w in weight.items())
    assert far < 0.08
    assert set(texts(outputs[3]).items()) <= set(texts(outputs[2]).items())


def test_packing_takes_every_copy(outputs):
    copies = outputs[3].count()
    rows = outputs[4].collect()
    assert sum(r.piece == 0 for r in rows) == copies
    use = {}
    for r in rows:
        use.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in use.values():
        members.sort()
        assert [o for o, _ in members] == np.cumsum([0] + [n for _, n in members])[:-1].tolist()
        assert sum(n for _, n in members) <= 2048
