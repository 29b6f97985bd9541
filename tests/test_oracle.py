"""Every SQL-expressible registered query against its DuckDB oracle."""

import pytest

from compare import compare, connect
from tidemark.plans import catalog

# Results that are legitimately empty on the smallest tables.
MAY_BE_EMPTY = {"anomaly_severe", "top_spikes"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_oracle(spark, con, sf_dir, name):
    problems = compare(catalog.QUERIES[name](spark, sf_dir), con, catalog.ORACLES[name])
    assert not [p for p in problems if not (p == "no rows to compare" and name in MAY_BE_EMPTY)]


def test_registry_is_complete():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert catalog.FLAGSHIP in catalog.ORACLES


def test_driver_contract(spark):
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
