import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """rows (doc_id, text[, source]) -> a documents table, with columns whose names could clash."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        for extra in ("fp", "rep", "cell", "node", "component", "a", "b", "h", "start", "hash", "copy", "seg"):
            df = df.selectExpr("*", f"'x' AS {extra}")
        return df
    return make


@pytest.fixture(scope="session")
def sf_docs():
    """The documents of sf0.01 as {doc_id: text}."""
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(t["doc_id"], t["text"]))
