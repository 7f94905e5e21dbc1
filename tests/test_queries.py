"""Every query against its SQL on the smallest tables."""

import pytest
from compare import difference, duck
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from tagloom.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_entry(spark):
    tagged = entry(spark)
    assert tagged.columns == ["id", "guid", "tags", "tagged"]
    assert tagged.filter("tagged = 1").count() > 0
