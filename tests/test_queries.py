"""Every query that has SQL against it on the smallest tables; queries without SQL have tests of their own."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from compare import connect, difference  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 40


# Expected counts at scale 0.001.
@pytest.mark.parametrize("name, rows", [("rollup_5min", 40), ("voltage_alerts", 7), ("packet_flows", 756), ("packet_alerts", 1), ("spike_alerts", 0)])
def test_known_counts(spark, name, rows):
    if SF_DIR.endswith("sf0.001"):
        assert queries()[name](spark, SF_DIR).count() == rows
