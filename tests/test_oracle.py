"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL, canon

KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "n"]
    assert 0 < df.count() <= 40
