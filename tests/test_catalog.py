import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from trendloom.plans.catalog import REGISTRY  # noqa: E402

WITH_SQL = sorted(name for name, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module")
def duck():
    return compare.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", WITH_SQL)
def test_rows_match_sql(spark, duck, sf, name):
    ok, note = compare.compare(spark, duck, sf, name)
    assert ok, note


LAZY = [n for n in WITH_SQL if not n.startswith("stream_")]


@pytest.mark.parametrize("name", LAZY)
def test_plan_pairs_no_rows_blindly(spark, sf, name):
    plan = REGISTRY[name].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
