"""Physical-plan guards over every batch query: no cartesian products or nested-loop
joins, filters pushed into the fact scans, no full-width reads."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

STREAMING = {"stream_tumbling", "stream_topics", "stream_late", "stream_source", "stream_passthrough", "live_anomalies"}
KEYS = sorted(set(E.QUERIES) - STREAMING)


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_products(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_clean_trips_pushes_filters_and_prunes_columns(spark):
    df = E.queries()["clean_trips"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
    # the area restriction is a semi-join on the dimension side, below the fact joins
    assert plan.index("LeftSemi") > plan.index("BroadcastHashJoin")


def test_history_reuses_the_series_partitioning(spark):
    """Grid aggregate and history windows run on the single (flow type, zone) shuffle."""
    import re

    df = E.queries()["standardize"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)[^\n]*", plan)
    assert len(exchanges) == 1, exchanges  # the counts themselves are in the written window table
    assert "REPARTITION_BY_COL" in plan
