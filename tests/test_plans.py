"""Plan shape of every registered query: the scale rules as assertions."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tagloom.plans.queries import QUERIES

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith("stream_")))
def test_no_cross_join_or_row_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for op in BANNED:
        assert op not in plan, f"{name} plans {op}"


def test_token_scan_reads_only_text(spark):
    df = E.queries()["token_count"](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    scans = [ln for ln in qe.executedPlan().toString().split("\n") if "FileScan parquet" in ln]
    assert scans and all("ReadSchema: struct<text:string>" in ln for ln in scans)
    # partial (map-side) aggregate before the shuffle
    assert qe.executedPlan().toString().count("HashAggregate") >= 2


def test_window_top_k_limits_before_shuffle(spark):
    df = E.queries()["sliding_top10"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pruning_and_pushdown_in_graph_inputs(spark):
    from tagloom.plans import graph_inputs as gi
    # the vertex-file join reads only id/label columns of part
    plan = gi.supply_vertices(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" in plan and "p_retailprice" not in plan and "p_brand" not in plan
    # a slice's occurrence scan pushes its filter into the parquet reader
    pairs = gi.supply_pairs(spark, SF_SMALL, "A")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)]" in plan
    assert "l_quantity" not in plan
