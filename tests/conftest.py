import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martflow.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from martflow.sources.tables import TABLE_NAMES
    con = duckdb.connect()
    for t in TABLE_NAMES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
