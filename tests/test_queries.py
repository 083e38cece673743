"""Every registered core query against its SQL on the smallest tables; the contract of the entry module."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import compare, connect

ROOT = Path(__file__).resolve().parent.parent
SF = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")

import __spark_entry__ as entry_module  # noqa: E402
from cratework.plans import relational_queries, training_queries, transform_queries  # noqa: E402

CORE = relational_queries.QUERIES | transform_queries.QUERIES | training_queries.QUERIES
SQL = relational_queries.ORACLE | transform_queries.ORACLE | training_queries.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, con, name):
    if name in SQL:
        got, want = compare(spark, con, SF, CORE[name], SQL[name])
        assert got == want
    else:
        assert CORE[name](spark, SF).count() > 0


def test_names():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q) and {f"p{n}_found" for n in (1, 2, 3, 5, 6)} <= set(q)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_core_stands_alone(tmp_path):
    """Without the text subpackage everything else still imports, and nothing else names it."""
    code = "import sys; sys.modules['cratework.llm'] = None; import __spark_entry__ as e; assert 'p1_found' in e.queries() and 'p7_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
    for p in (ROOT / "cratework").rglob("*.py"):
        if "llm" not in p.parts:
            assert "cratework.llm" not in p.read_text(), p
