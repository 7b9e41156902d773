"""Graph inputs derived from the test tables.

The reference reads an edge file (one "src dst" line per occurrence of
a relation) and a vertex file ("id label"). Here each input row is one
occurrence, so no pairs are generated inside a group:

* supply graph: every lineitem row is one occurrence of "part was
  shipped by supplier"; vertices are parts (label p_name; 64 distinct
  names, so merging by label collapses parts) and suppliers;
* activity graph: every event row is one occurrence of "user did
  event_type"; only the event types have a vertex-file entry, so user
  vertices get the default label "";
* loyalty graph: every order is one occurrence of "customer buys in its
  block"; many components, missing labels and self-loops.

Parts and suppliers share key ranges; suppliers (and event types) are
moved into their own id range by adding ``ID_BASE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.graph import (Graph, attach_labels, create_graph, create_stacked, fold_flips,
                                     from_edges, merge_stacked)
from tagloom.operators.indexing import dense_id
from tagloom.session import checkpoint
from tagloom.sources.tables import table

ID_BASE = 10 ** 12
SUPPLY_THRESHOLD = 2        # edges seen more than twice
SLICE_THRESHOLD = 1         # per-slice graphs for the merge
ACTIVITY_THRESHOLD = 15
LOYALTY_THRESHOLD = 4       # a customer's orders of one priority
BLOCK = 12                  # customers per block in the loyalty graph


def supply_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + F.lit(ID_BASE)).alias("id"),
                                                F.col("s_name").alias("label"))
    return p.unionByName(s)


def supply_pairs(spark: SparkSession, sf_dir: str, returnflag: str | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    if returnflag is not None:
        li = li.filter(F.col("l_returnflag") == F.lit(returnflag))
    return li.select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + F.lit(ID_BASE)).alias("dst"))


def supply_graph(spark: SparkSession, sf_dir: str, num: int = SUPPLY_THRESHOLD) -> Graph:
    return create_graph(supply_vertices(spark, sf_dir), supply_pairs(spark, sf_dir), num)


def slices(df: DataFrame, col: str) -> tuple[Column, int]:
    """(``gid`` of each row, number of graphs): one graph per value of
    ``col``, in value order, a null value first. The distinct values (a
    handful by nature of a slicing column) are read from the data."""
    values = [r[0] for r in df.select(col).distinct().orderBy(F.col(col).asc_nulls_first()).collect()]
    gid = F.lit(None).cast("int")
    for i, v in enumerate(values):
        gid = F.when(F.col(col).eqNullSafe(F.lit(v)), F.lit(i)).otherwise(gid)
    return gid, len(values)


def supply_slices(spark: SparkSession, sf_dir: str, num: int = SLICE_THRESHOLD) -> tuple[Graph, int]:
    """One graph per l_returnflag value, stacked; and their number."""
    li = table(spark, sf_dir, "lineitem")
    gid, n = slices(li, "l_returnflag")
    pairs = li.select(gid.alias("gid"), F.col("l_partkey").alias("src"),
                      (F.col("l_suppkey") + F.lit(ID_BASE)).alias("dst"))
    return create_stacked(supply_vertices(spark, sf_dir), pairs, num), n


def merged_supply_graph(spark: SparkSession, sf_dir: str, reverse: bool = False) -> Graph:
    """The slice graphs merged by label, as one graph. ``reverse``: edge
    directions of merge(g3, merge(g1, g2)) with (dst, src)-keyed sums."""
    stacked, n = supply_slices(spark, sf_dir)
    flip = {i for i, k in enumerate(fold_flips(n)) if k % 2 == 1} if reverse else None
    return merge_stacked(stacked, flip)


def loyalty_graph(spark: SparkSession, sf_dir: str, num: int = LOYALTY_THRESHOLD) -> Graph:
    """Orders as occurrences of "customer buys in its block", one graph per
    order priority, merged by label.

    A block is ``BLOCK`` customers in key order, so the number of blocks,
    and of components, grows with the table. Every fifth block is missing
    in the vertex file, as are its customers with a balance below 2000:
    they get the default label, collapse into one vertex, and edges between
    two of them become a self-loop.
    """
    cust, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    block = F.floor(F.col("c_custkey") / BLOCK)
    blocks = (cust.select(block.alias("b")).distinct().filter(F.col("b") % 5 != 0)
              .select((F.col("b") + F.lit(ID_BASE)).alias("id"),
                      F.concat(F.lit("block "), F.col("b").cast("string")).alias("label")))
    known = (block % 5 != 0) | (F.col("c_acctbal") >= 2000)
    vertices = cust.filter(known).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label")).unionByName(blocks)
    gid, _ = slices(orders, "o_orderpriority")
    pairs = orders.select(gid.alias("gid"), F.col("o_custkey").alias("src"),
                          (F.floor(F.col("o_custkey") / BLOCK) + F.lit(ID_BASE)).alias("dst"))
    return merge_stacked(create_stacked(vertices, pairs, num))


def activity_graph(spark: SparkSession, sf_dir: str, num: int = ACTIVITY_THRESHOLD) -> Graph:
    ev = table(spark, sf_dir, "events").select("user_id", "event_type")
    types = dense_id(ev.select("event_type").distinct(), ["event_type"], "_k")
    types = types.select((F.col("_k") + F.lit(ID_BASE)).alias("id"), F.col("event_type").alias("label"))
    # count by type name first, then join ids to the counts
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("weight")).filter(F.col("weight") > num)
    edges = checkpoint(counts.join(types.withColumnRenamed("label", "event_type"), "event_type")
                       .select(F.col("user_id").alias("src"), F.col("id").alias("dst"), "weight"))
    return Graph(checkpoint(attach_labels(from_edges(edges), types)), edges)


def supply_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The supply relation as the text files the line readers take:
    vertex lines ``"id label"`` and one edge line ``"src dst"`` per
    occurrence."""
    v = supply_vertices(spark, sf_dir).select(
        F.concat_ws(" ", F.col("id").cast("string"), F.col("label")).alias("value"))
    e = supply_pairs(spark, sf_dir).select(
        F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    return v, e
