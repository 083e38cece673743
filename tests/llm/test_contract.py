"""Columns and types of the queries whose rows are compared with known cases."""

import pytest
from oracle_check import compare, connect

from cratework.llm import queries

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "p4_found": [("first_record_id", "bigint"), ("copy_record_id", "bigint")],
    "p7_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p8_found": [("source", "string")],
    "p9_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_of_found(spark, name):
    assert queries.QUERIES[name](spark, SF).dtypes == CONTRACT[name]


@pytest.mark.parametrize("name", ["p7_found", "p8_found"])
def test_query_against_sql(spark, name):
    got, want = compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLE[name])
    assert got == want
