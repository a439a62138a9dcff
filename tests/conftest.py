import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sluice.session import build_session
    os.environ.setdefault("SLUICE_CHECKPOINT_DIR", str(tmp_path_factory.mktemp("ckpt")))
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
