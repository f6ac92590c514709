"""Every registered query against its SQL."""

import os

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry
from tallyhouse.plans.oracle import ORACLE
from tallyhouse.plans.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

# Too few rows at the smallest scale for these to find any.
MAY_BE_EMPTY = {"anomaly_drill", "cross_border"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(name, QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    if name in MAY_BE_EMPTY and problem == f"{name}: no rows":
        return
    assert problem is None


def test_entry(spark):
    assert entry(spark).count() > 0
