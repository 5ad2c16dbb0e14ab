"""Every registered query at the smallest scale against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_queries import compare, connect
from tests.conftest import SF_DIR
from verdigrid.plans.queries import CHECKS, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], CHECKS[name], SF_DIR) == ""
