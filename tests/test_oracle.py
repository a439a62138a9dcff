"""Every registered query against its independent DuckDB SQL (sf0.001, whole tables)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import canon  # noqa: E402
from check_types import FAMILY  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(k for k in entry.oracle_sql() if not k.startswith("op"))  # those are checked in tests/llm


def test_every_query_has_sql():
    rows_only = set(entry.queries()) - set(entry.oracle_sql())
    assert not [k for k in rows_only if not (k == "pipeline" or k.startswith("op"))]


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted(tuple(canon(r[i]) for i in order) for r in rows)
    b = sorted(tuple(canon(r[i]) for i in oorder) for r in orows)
    assert a == b
    described = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[key]}").fetchall()}
    for f in df.schema.fields:
        st = f.dataType.simpleString()
        assert described[f.name] == FAMILY.get(st, st.upper()), (f.name, st)


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["country_name", "artist", "total_streams"]
    assert df.count() > 0
