"""Every query of the library's own operators against its SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck
from folioloom.plans import queries as own

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: run for name, run in entry.queries().items() if name in own.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in own.QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1
