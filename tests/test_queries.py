"""Every query with SQL is compared with DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
import check_queries  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    verdict, _ = check_queries.compare(spark, con, name, queries()[name], ORACLES[name], SF_DIR)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    row = entry(spark).first()
    assert row["n"] > 0 and row["MAE"] > 0
