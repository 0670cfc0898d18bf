"""Every registered query against its SQL, and what their plans must not contain."""

from __future__ import annotations

import os

import __spark_entry__ as entry
import oracle
import pytest

from tidemark.sample_queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, QUERIES[name], entry.oracle_sql()[name], SF_DIR) is None


LOADS = ("stream_", "_loaded", "late_", "warehouse_", "text_list")


@pytest.mark.parametrize("name", [n for n in QUERIES if not any(x in n for x in LOADS)])
def test_plan_stays_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan or (name, node) in BOUNDED


#: Joins with a frame of one row.
BOUNDED = {(n, "BroadcastNestedLoopJoin") for n in ("peak_month",)}


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].asDict().keys() >= {"state", "date", "confirmed", "deaths"}
