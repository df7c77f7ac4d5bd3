"""Every catalogue query against its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

from tests.oracle import compare, duck
from tidewright.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    if not Path(SF).exists():
        pytest.skip("test tables not present")
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    ok, note = compare(spark, SF, QUERIES[name], ORACLES.get(name), connection)
    assert ok, note


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
