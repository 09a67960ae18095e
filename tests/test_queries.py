"""Every registered query against its SQL, on the smallest given tables."""

import pytest

from __spark_entry__ import entry
from ledgerlake.plans.queries import ORACLES, QUERIES
from tools.check_sql import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, FOLDER, name, ORACLES[name])
    # a few conditions do not occur in the smallest tables
    assert problem in (None, "empty")
