"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry
from seriesmill.plans.registered import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    rows = entry.queries()[name](spark, SF_DIR)
    wrong = oracle.compare(rows, duck, SQL[name])
    assert wrong is None or wrong == "both empty"


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
