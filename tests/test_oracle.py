"""Every registered query against its DuckDB oracle (or rows-only when it has none).

Runs at sf0.001 by default (set TENDERLAKE_TEST_SF to another sf directory).
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = os.environ.get("TENDERLAKE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
SQL = E.oracle_sql()

@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    problems, nrows, _, _ = compare(name, spark, SF, con, QUERIES[name], SQL[name])
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "buyer_country" in df.columns
