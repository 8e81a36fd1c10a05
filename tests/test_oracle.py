"""Every registered query against its DuckDB oracle at the smoke scale."""

import pytest

from meridian.plans.checking import compare, duckdb_conn
from meridian.plans.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con, exact=True)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    import importlib.util, os
    spec = importlib.util.spec_from_file_location(
        "spark_entry", os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    df = m.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(m.queries())


def test_entry_without_the_libraries_of_optional_operators():
    import os, subprocess, sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['zstandard'] = sys.modules['xxhash'] = sys.modules['sentencepiece'] = None; "
            "import __spark_entry__ as e; from meridian.plans.registry import QUERIES; assert set(QUERIES) <= set(e.queries())")
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, check=True, timeout=120)
