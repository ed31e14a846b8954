"""Every registered query against its check SQL."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF
from oracle.checks import CHECKS
from tripweave.catalog import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_names():
    assert set(QUERIES) <= set(queries()) and set(CHECKS) <= set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck.sql(CHECKS[name])) is None


def test_entry(spark):
    assert entry(spark).count() > 0

