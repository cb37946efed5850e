"""Every registered query against DuckDB, on the smallest test tables."""

from pathlib import Path

import pytest

from compare import differences, star_schema
from gradeledger.checks.registry import CHECKS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return star_schema(SF)


@pytest.mark.parametrize("name", [n for n, c in CHECKS.items() if c.sql is not None])
def test_equals_oracle(spark, duck, name):
    rows, ours, theirs = differences(spark, duck, name, SF)
    assert rows > 0 or name == "dq_duplicates"
    assert not ours and not theirs


def test_every_query_has_sql():
    assert all(c.sql is not None for c in CHECKS.values())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
