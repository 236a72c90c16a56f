"""Every catalog query against its DuckDB twin on the smallest scale factor.

Queries without an SQL twin are run for their rows.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_harness import compare, duck

SF = os.environ.get("TRENDLAKE_TEST_SF", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
NAMES = [n for n in QUERIES if n != "pipeline" and not n.startswith("op")]  # those have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert res.get("ok") is not False, res
    assert res["rows"] > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["region", "date", "video_id"]
    df.collect()
