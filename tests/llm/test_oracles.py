"""Queries with SQL against DuckDB on the smallest tables; every query reads its whole table."""

import duckdb
import pytest

from cases import SMALL
from civicflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SMALL)
    want = con.sql(queries.ORACLES[name])
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_quality_classifier", "op5_stratified_shards", "op6_language_id"])
def test_query_has_a_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    assert got.count() == got.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
