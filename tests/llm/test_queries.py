"""Registered queries: the DuckDB oracle where there is one, contract columns elsewhere."""

import duckdb
import pytest

from sluice.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert got.columns == columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


CONTRACT = {
    "op1": "doc_id bigint, fingerprint string, component_id bigint",
    "op2": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op3": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op6": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op11": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op12": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
            "runs_sha256 string, collapsed_sha256 string",
}


@pytest.mark.parametrize("op", sorted(CONTRACT))
def test_contract_columns(spark, op):
    name = next(q for q in queries.QUERIES if q.startswith(op + "_"))
    df = queries.QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert CONTRACT[op].split(", ") == [f"{c} {kinds[c]}" for c in (x.split()[0] for x in CONTRACT[op].split(", "))]
    key = df.columns[0]
    table = "embeddings" if op in ("op2", "op3") else "documents"
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    if op not in ("op3", "op10"):
        assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in rows.select(rows.columns[0]).collect())
