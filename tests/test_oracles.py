"""Every registered query against its SQL over the whole test tables."""

import pytest

import __spark_entry__ as entry
from checks import catalog
from checks.compare import difference, duck

QUERIES, SQL = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:3] == ["periode", "annee", "mois"] and frame.count() > 0
