import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from helpers import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from quillspark.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="quillspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from quillspark.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
