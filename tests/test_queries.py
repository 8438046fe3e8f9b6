"""Every query that SQL can express agrees with DuckDB on the smallest tables."""

import pytest
from check_sql import compare, connect

from forumlens.plans import CATALOG


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql is not None])
def test_matches_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, CATALOG[name].run, CATALOG[name].sql, sf_dir) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "monthly_activity" in entry.queries()
