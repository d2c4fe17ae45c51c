"""Every query of the workload: results against SQL, and the shape of its plan."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from rentledger.plans import workload
from rentledger.plans.oracles import ORACLES, SIZED_FOLDER
from tests.oracle_check import differences, oracle_connection

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

# Row-at-a-time or pairwise work that must not appear in any plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query(spark, oracle, name):
    frame = workload.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in FORBIDDEN if operator in plan]
    assert differences(frame, oracle, ORACLES[name].replace(SIZED_FOLDER, FOLDER)) == []


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["address", "revenue"] and frame.count() == 25


def test_every_query_has_sql():
    assert set(workload.queries()) == set(ORACLES)
    assert set(workload.queries()) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())
