"""Every registered query against its SQL, over the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry
from orestrata.plans.oracle import ORACLE
from orestrata.plans.queries import QUERIES
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).columns == [
        "category",
        "total_orders",
        "total_units",
        "total_revenue",
        "avg_revenue_per_unit",
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare(db, ORACLE[name], df) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for part in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert part not in plan
