"""The registered queries of the operators, next to their SQL or with the columns of their contracts."""

from __future__ import annotations

import os

import duckdb
import pytest

from check_queries import compare
from viewrank.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op11_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12_embedding_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for table in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, tables, name):
    report = compare(spark, tables, SF_DIR, name)
    assert ": ok" in report, report


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_of_the_contract(spark, name):
    assert queries.queries()[name](spark, SF_DIR).columns == COLUMNS[name].split()


def test_edited_texts_are_near_and_unrelated_ones_are_not(spark):
    rows = queries.op13_document_fingerprints(spark, SF_DIR).collect()
    near = [row.near_edited for row in rows if row.n_chars >= 400]
    assert len(rows) == 200 and min(near) > 0.3 and sum(near) / len(near) > 0.55
    assert sorted(row.near_next for row in rows)[190] < 0.3
    for row in rows:
        assert 0 <= row.near_next <= 1 and len(row.fingerprint) == 256


def test_whitened_table_has_unit_covariance(spark):
    rows = queries.op12_embedding_whitening(spark, SF_DIR)
    first = rows.first()
    assert first.identity_error < 1e-9 and rows.count() == 32 * first.n
    shares = [r.explained for r in rows.filter(f"vec_id = {first.vec_id}").orderBy("component").collect()]
    assert shares == sorted(shares, reverse=True) and 0 < sum(shares) < 1
