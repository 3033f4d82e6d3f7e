"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import oracle
from sitetally.plans import catalog


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query(spark, con, key):
    df = catalog.QUERIES[key](spark, SF_DIR)
    assert oracle.differences(df, con, catalog.ORACLE[key]) == ""


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() == 1
    assert set(catalog.QUERIES) == set(catalog.ORACLE) and set(catalog.QUERIES) <= set(entry.queries())


def test_plans_have_no_cartesian_product(spark):
    for key in ("site_features", "host_report", "enrich_jobs", "city_topup", "robots_allowed", "market_share"):
        plan = catalog.QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_page_bodies_are_not_shuffled(spark):
    """No exchange below the first aggregation carries the body or a text made from it."""
    for key in ("site_hits", "site_features", "site_flags"):
        plan = catalog.QUERIES[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        first_agg = plan.index("Aggregate")
        assert "html#" not in plan[first_agg:plan.index("\n", first_agg)], key
