"""Every registered query against its check SQL, and its plan against what must not be in it."""

import os

import oracle
import pytest

from webcat.plans import registry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(registry.queries())
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    allowed = {"no rows"} if name in {"redirect_duplicates"} else set()
    assert set(oracle.compare(spark, name, SF)) <= allowed


@pytest.mark.parametrize("name", [n for n in NAMES if "roundtrip" not in n and n not in ("stream_links", "link_documents", "frontier_reach", "crawl_walk")
                                  and not n.startswith("discovery_") and n != "site_summaries"])
def test_plan(spark, name):
    df = oracle.spark_entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_every_query_has_check_sql():
    assert set(registry.oracle_sql()) == set(NAMES)


def test_entry(spark):
    df = oracle.spark_entry.entry(spark)
    assert df.columns == ["site_name", "discovery_method", "n_urls"]
    assert df.count() > 0
