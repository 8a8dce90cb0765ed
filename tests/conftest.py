import os
import sys
import tempfile

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskloom.session import build_session  # noqa: E402
from riskloom.sources.tables import TABLE_NAMES, table_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app="riskloom-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="riskloom-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="riskloom-test-wh-")})
    yield s
    s.stop()


def duck_for(sf_dir):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


@pytest.fixture(scope="session")
def duck_small():
    return duck_for(SF_SMALL)


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="riskloom-test-")
