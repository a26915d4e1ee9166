"""Registered queries that have an SQL twin equal it."""

from __future__ import annotations

import duckdb
import pytest

from checks.compare import difference
from rivulet.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    rows = queries.QUERIES[name](spark, SF).toPandas()
    assert difference(rows, con.execute(queries.ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_has_the_contract_columns(spark, name):
    wanted = {
        "op1": "doc_id piece start n_tokens bucket padding batch slot",
        "op2": "query_id rank vec_id score",
        "op4": "doc_id held_out score predicted",
        "op5": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op7": "doc_id template start end containment",
        "op8": "doc_id n_bytes n_tokens over_limit",
        "op9": "doc_id fingerprint component_id",
        "op10": "doc_id held_out lang_pred score",
        "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"}[name.split("_")[0]]
    assert queries.QUERIES[name](spark, SF).columns == wanted.split()
