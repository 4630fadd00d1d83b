import os
import sys
import tempfile

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from daypulse.session import build_session  # noqa: E402
from daypulse.sources.tables import TABLES  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("daypulse-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "8g"})
    sc = s.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="daypulse-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="daypulse-test-", dir="/tmp")
