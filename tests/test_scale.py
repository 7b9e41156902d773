"""One rule for every size, and plans that spread giant groups and hubs."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tagloom.operators import components, counting, graph, indexing, topk
from tagloom.plans import graph_inputs as gi
from tagloom.plans.queries import QUERIES
from tagloom.session import checkpoint
from tagloom.sources.pages import decode_entities, extract_questions, extract_records


@contextmanager
def conf(spark, **values):
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_broadcast(spark, **more):
    return conf(spark, spark__sql__autoBroadcastJoinThreshold=-1,
                spark__sql__adaptive__autoBroadcastJoinThreshold=-1, **more)


def hub_plans(spark):
    return no_broadcast(spark, spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
                        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
                        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# --- sizes on both sides of the bounds -----------------------------------------

@pytest.mark.parametrize("n", [10_000, 10_001])
def test_component_lines_follow_one_rule(spark, n):
    comp = spark.range(n).select("id", F.lit(0).cast("long").alias("component"))
    got = sorted((r["chunk"], [int(x) for x in r["members"].split(", ")])
                 for r in components.isolated_groups(comp).collect())
    assert [c for c, _ in got] == list(range(-(-n // 10_000)))
    assert [x for _, m in got for x in m] == list(range(n))


@pytest.mark.parametrize("n", [10_000, 10_001])
def test_count_maps_follow_one_rule(spark, n):
    counts = spark.range(n).select(F.lit(1).alias("w"), F.format_string("t%06d", "id").alias("tag"),
                                   F.col("id").alias("cnt"))
    maps = {r["part"]: r["counts"] for r in counting.counts_as_map(counts, ["w"]).collect()}
    assert sorted(maps) == list(range(-(-n // 10_000)))
    assert [v for p in sorted(maps) for v in sorted(maps[p].values())] == list(range(n))
    pairs = counting.counts_as_pairs(counts.filter("cnt < 5"), ["w"], max_keys=3).orderBy("part").collect()
    assert [[tuple(x) for x in r["pairs"]] for r in pairs] == [
        [("t000000", 0), ("t000001", 1), ("t000002", 2)], [("t000003", 3), ("t000004", 4)]]


def test_group_position_over_partitions(spark):
    rows = [(g, i) for g, n in ((None, 3), ("a", 700), ("b", 1), ("c", 2), ("d", 300)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(5)
    got = indexing.group_position(df, ["g"], ["i"], "p", num_partitions=9).collect()
    assert len(got) == len(rows) and all(r["p"] == r["i"] for r in got)
    assert indexing.group_position(df.filter("false"), ["g"], ["i"], "p").count() == 0


def test_every_question_of_a_page(spark):
    block = '<div class="question-summary"><h3><a href="/questions/{n}/s" class="question-hyperlink">Q &lt;{n}&gt;</a></h3></div>'
    page = spark.createDataFrame([(1, "".join(block.format(n=n) for n in range(80)))], "page_id long, html string")
    got = extract_questions(page).orderBy("block_no").collect()
    assert [r["questions"] for r in got] == [[f"Q <{n}>"] for n in range(80)]
    assert all(r["views"] is None and r["tags"] == [] for r in got)


def test_entities_are_decoded_once_and_absent_fields_are_null(spark):
    cases = {"a &amp;lt; b": "a &lt; b", "&lt;x&gt; &quot;&#39;&#x41;&#128512;": "<x> \"'A\U0001F600", "AT&T; &foo; &": "AT&T; &foo; &",
             "": "", "&#0;&#55296;": "&#0;&#55296;"}
    df = spark.createDataFrame(list(cases.items()), "raw string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", decode_entities(F.col("raw"))).collect())
    r = extract_records(spark.createDataFrame([(1, "<p>no title</p>"), (2, None)], "page_id long, html string")).collect()
    assert [(x["title"], x["heading"]) for x in r] == [(None, None)] * 2


def test_slices_come_from_the_data(spark):
    df = spark.createDataFrame([("B",), (None,), ("A",), ("X",), ("A",)], "f string")
    gid, n = gi.slices(df, "f")
    assert n == 4 and {(r[0], r[1]) for r in df.select("f", gid).collect()} == {(None, 0), ("A", 1), ("B", 2), ("X", 3)}


# --- top-K for any K --------------------------------------------------------------

def test_large_top_k_has_no_single_task(spark):
    counts = spark.range(20_000).select((F.col("id") % 3).alias("w"), F.format_string("t%05d", "id").alias("tag"),
                                        (F.col("id") * 7919 % 20_000).alias("cnt"))
    top = topk.top_k(counts, 5000)
    plan = final_plan(top)
    assert "TakeOrderedAndProject" in plan and "SinglePartition" not in plan
    assert [r["rnk"] for r in top.orderBy("rnk").collect()] == list(range(1, 5001))
    grouped = topk.group_top_k(counts, ["w"], 5000)
    plan = final_plan(grouped)
    assert "SinglePartition" not in plan and plan.count("Window ") + plan.count("Window [") >= 2
    assert grouped.groupBy("w").count().collect() == [r for r in grouped.groupBy("w").count().collect() if r["count"] == 5000]
    assert "WindowGroupLimit" in final_plan(topk.group_top_k(counts, ["w"], 10))


# --- giant groups and hubs ---------------------------------------------------------

def _busy_tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_giant_groups_spread_over_tasks(spark):
    with no_broadcast(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        comp = spark.range(200_000).select("id", F.lit(0).cast("long").alias("component"))
        assert _busy_tasks(components.isolated_groups(comp, 1000)) > 1
        counts = spark.range(50_000).select(F.lit(1).alias("w"), F.col("id").cast("string").alias("tag"), F.lit(1).alias("cnt"))
        assert _busy_tasks(counting.counts_as_map(counts, ["w"], max_keys=500)) > 1


@pytest.fixture(scope="module")
def hub(spark):
    """A hub with 60,000 leaves and as many other edges."""
    e = spark.range(120_000).select(
        F.when(F.col("id") < 60_000, F.lit(0)).otherwise(F.col("id") + 200_000).alias("src"),
        (F.col("id") + 1).alias("dst"), F.lit(1).cast("long").alias("weight"))
    ids = e.select(F.col("src").alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
    return graph.Graph(checkpoint(ids.withColumn("label", F.col("id").cast("string"))), checkpoint(e))


@pytest.mark.parametrize("view", ["triplets", "touching", "subgraph", "large_star", "small_star"])
def test_hub_joins_are_split(spark, hub, view):
    uv = hub.edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    vu = uv.select(F.col("v").alias("u"), F.col("u").alias("v")).filter("u < v").unionAll(
        spark.range(60_000).select((F.col("id") + 1).alias("u"), F.lit(900_000).cast("long").alias("v")))
    with hub_plans(spark):
        df = {"triplets": lambda: graph.triplets(hub),
              "touching": lambda: graph.edges_touching(hub.edges, hub.vertices.select("id")),
              "subgraph": lambda: graph.subgraph(hub, F.col("label") != "5").edges,
              "large_star": lambda: components._large_star(uv),
              "small_star": lambda: components._small_star(checkpoint(vu))}[view]()
        assert "skew=true" in final_plan(df)


# --- every plan, also those handed to checkpoint() ------------------------------------

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_behind_checkpoints(spark, name, monkeypatch):
    seen = []
    kind = type(spark.range(0))
    real = kind.checkpoint

    def noted(self, *a, **k):
        seen.append(self._jdf.queryExecution().executedPlan().toString())
        return real(self, *a, **k)

    monkeypatch.setattr(kind, "checkpoint", noted)
    seen.append(QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())
    for plan in seen:
        assert not any(op in plan for op in BANNED), f"{name} plans {plan[:2000]}"
    graphs = ("supply_", "merged_", "loyalty_", "activity_")
    if name.startswith(graphs):
        assert len(seen) > 1        # the parts before checkpoints were seen


def test_merged_vertices_skip_the_edges(spark, monkeypatch):
    seen = []
    kind = type(spark.range(0))
    real = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: (seen.append(1), real(self, *a, **k))[1])
    QUERIES["merged_vertices"](spark, SF_SMALL).collect()
    assert len(seen) == 3


def test_token_chunks_shuffle_the_text_once(spark, monkeypatch):
    plans = []
    kind = type(spark.range(0))
    real = kind.checkpoint

    def noted(self, *a, **k):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return real(self, *a, **k)

    monkeypatch.setattr(kind, "checkpoint", noted)
    last = QUERIES["token_chunks"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(plans) == 1 and "rangepartitioning(doc_id" in plans[0] and "hashpartitioning(_part" not in plans[0]
    assert "Join" not in last
