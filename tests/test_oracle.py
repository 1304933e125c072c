"""Every registered query with SQL against it, in an independent engine; the others have tests of their own."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from tickharbor.plans.oracles import ORACLES
from tickharbor.plans.registry import QUERIES

from .oracle import connect, differences

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees(spark, duck, name):
    assert differences(queries()[name](spark, SF), duck, oracle_sql()[name]) is None


def test_every_sql_has_a_query_and_every_tick_query_has_sql():
    assert oracle_sql().keys() <= queries().keys()
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert entry(spark).count() > 0
