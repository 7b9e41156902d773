"""Weighted, labelled graphs as two DataFrames.

``vertices(id BIGINT, label STRING)`` and ``edges(src BIGINT, dst BIGINT,
weight BIGINT)``; edges are directed and may repeat (a multigraph).
Every operator is a DataFrame plan: the joins are equi-joins on vertex
ids or labels. The side with one row per vertex is checkpointed before
such a join: a plain scan has a shuffle of its own, which AQE needs on
both sides to split a hub vertex's partition. Aggregates combine map-side.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.counting import edge_count
from tagloom.operators.indexing import dense_id
from tagloom.session import checkpoint


class Graph(NamedTuple):
    vertices: DataFrame
    edges: DataFrame

    def persist(self) -> "Graph":
        return Graph(self.vertices.persist(), self.edges.persist())

    def unpersist(self) -> None:
        self.vertices.unpersist()
        self.edges.unpersist()


# --- building --------------------------------------------------------------

def from_edges(edges: DataFrame) -> DataFrame:
    """The ids that occur in ``edges`` (either end), once each."""
    return (edges.select(F.col("src").alias("id"))
            .union(edges.select(F.col("dst").alias("id"))).distinct())


def unique_labels(vertices: DataFrame) -> DataFrame:
    """One label per id: a vertex file may list an id twice; keep the least label."""
    return vertices.groupBy("id").agg(F.min("label").alias("label"))


def attach_labels(ids: DataFrame, vertices: DataFrame, default: str = "") -> DataFrame:
    """``ids`` LEFT JOIN the vertex file; ids without a label get ``default``."""
    return (ids.join(unique_labels(vertices), "id", "left")
            .select("id", F.coalesce(F.col("label"), F.lit(default)).alias("label")))


def create_graph(vertices: DataFrame, pairs: DataFrame, num: int,
                 materialize: bool = True) -> Graph:
    """Edges = (src, dst) pairs seen more than ``num`` times, weight = count;
    vertices = the ids on those edges with their labels.

    With ``materialize`` the thresholded edges (far fewer rows than the
    occurrences) and the labelled vertices are checkpointed once; the
    triplet joins and the degree counts then read them instead of
    re-aggregating the occurrences.
    """
    edges = edge_count(pairs.select("src", "dst"), num)
    if materialize:
        edges = checkpoint(edges)
    v = attach_labels(from_edges(edges), vertices)
    return Graph(checkpoint(v) if materialize else v, edges)


def create_stacked(vertices: DataFrame, pairs: DataFrame, num: int,
                   materialize: bool = True) -> Graph:
    """``create_graph`` for many graphs at once; ``pairs`` carries ``gid``.

    One aggregate over all occurrences instead of one scan per graph.
    The thresholded edges (far fewer rows than the occurrences) and the
    labelled vertex sets are checkpointed once when ``materialize``: a
    merge reads them several times (label ids, relabelling, sums), and
    every read then starts from the checkpoint instead of from the
    occurrence scan and the vertex-file join.
    """
    edges = edge_count(pairs.select("gid", "src", "dst"), num, by=["gid"])
    if materialize:
        edges = checkpoint(edges)
    ids = (edges.select("gid", F.col("src").alias("id"))
           .union(edges.select("gid", F.col("dst").alias("id"))).distinct())
    v = (ids.join(unique_labels(vertices), "id", "left")
         .select("gid", "id", F.coalesce(F.col("label"), F.lit("")).alias("label")))
    if materialize:
        v = checkpoint(v)
    return Graph(v, edges)


# --- views -----------------------------------------------------------------

def triplets(g: Graph) -> DataFrame:
    """Edges with both endpoint labels."""
    s = g.vertices.select(F.col("id").alias("src"), F.col("label").alias("src_label"))
    d = g.vertices.select(F.col("id").alias("dst"), F.col("label").alias("dst_label"))
    return g.edges.join(s, "src").join(d, "dst").select(
        "src", "src_label", "dst", "dst_label", "weight")


def degrees(g: Graph) -> DataFrame:
    """In + out degree per id; a self-loop counts twice; isolated ids absent."""
    ends = g.edges.select(F.col("src").alias("id")).unionAll(g.edges.select(F.col("dst").alias("id")))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def low_degree_vertices(g: Graph, max_degree: int = 2) -> DataFrame:
    """Ids whose degree is 1..max_degree (degree < 3 by default)."""
    return degrees(g).filter(F.col("degree") <= F.lit(max_degree)).select("id")


# --- sub-graphs ------------------------------------------------------------

def edges_touching(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with src OR dst in ``ids`` (distinct ids).

    An OR of two memberships would plan as a nested-loop join; two
    equi left-joins keep it a pair of hash/sort-merge joins.
    """
    ids = checkpoint(ids)
    s = ids.select(F.col("id").alias("src"), F.lit(True).alias("_s"))
    d = ids.select(F.col("id").alias("dst"), F.lit(True).alias("_d"))
    return (edges.join(s, "src", "left").join(d, "dst", "left")
            .filter(F.col("_s").isNotNull() | F.col("_d").isNotNull())
            .select(*edges.columns))


def edges_within(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with both src AND dst in ``ids`` (distinct ids)."""
    ids = checkpoint(ids)
    return (edges.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
            .join(ids.select(F.col("id").alias("dst")), "dst", "left_semi"))


def subgraph(g: Graph, vertex_filter=None, edge_filter=None) -> Graph:
    """Keep vertices passing ``vertex_filter`` and edges passing
    ``edge_filter`` whose both ends were kept."""
    v = g.vertices if vertex_filter is None else g.vertices.filter(vertex_filter)
    e = g.edges if edge_filter is None else g.edges.filter(edge_filter)
    if vertex_filter is not None:
        e = edges_within(e, v.select("id"))
    return Graph(v, e)


def low_degree_subgraph(g: Graph, max_degree: int = 2) -> Graph:
    """Edges touching a vertex of degree 1..max_degree; all vertices kept."""
    return Graph(g.vertices, edges_touching(g.edges, low_degree_vertices(g, max_degree)))


def low_degree_induced(g: Graph, max_degree: int = 2) -> Graph:
    """Only low-degree vertices, and the edges between two of them."""
    ids = low_degree_vertices(g, max_degree)
    return Graph(g.vertices.join(ids, "id", "left_semi"), edges_within(g.edges, ids))


# --- merging ---------------------------------------------------------------

def stack(graphs: list[Graph]) -> Graph:
    """N graphs as one graph keyed by ``gid`` (0..N-1)."""
    v = reduce(lambda a, b: a.unionByName(b),
               [g.vertices.select(F.lit(i).alias("gid"), "id", "label") for i, g in enumerate(graphs)])
    e = reduce(lambda a, b: a.unionByName(b),
               [g.edges.select(F.lit(i).alias("gid"), "src", "dst", "weight")
                for i, g in enumerate(graphs)])
    return Graph(v, e)


def fold_flips(n: int) -> list[int]:
    """How often a pairwise fold ``merge(g_k, ... merge(g_1, g_2))`` that
    keys edges on (dst, src) flips each graph's edges: g_1 and g_2 once
    per level (n - 1), g_k (k >= 3) n - k + 1 times."""
    return [n - 1, n - 1] + [n - k + 1 for k in range(3, n + 1)] if n >= 2 else [0] * n


def merge_stacked(stacked: Graph, flip: set | None = None, materialize: bool = True) -> Graph:
    """Merge all graphs of a stacked graph by label, in one pass.

    Equal labels become one vertex (within one graph too); merged
    vertices get dense ids in label order; parallel edges add their
    weights. ``flip`` lists the gids whose edges change direction.
    With ``materialize`` the merged edges are checkpointed: degrees,
    sub-graphs, components and writers read them several times, and
    each read would otherwise redo the relabelling joins. Callers that
    need the vertices only use ``merged_vertices``.
    """
    v = merged_vertices(stacked)
    return Graph(v, merged_edges(stacked, v, flip, materialize))


def merged_vertices(stacked: Graph) -> DataFrame:
    """``id, label`` of the merge: distinct labels with dense ids in label order."""
    v = dense_id(stacked.vertices.select("label").distinct(), ["label"], "id")
    return v.select("id", "label")


def merged_edges(stacked: Graph, v: DataFrame, flip: set | None = None, materialize: bool = True) -> DataFrame:
    """Edges of the merge between the ids of ``v``, parallel weights added."""
    m = stacked.vertices.join(v.select("label", F.col("id").alias("_new")), "label").select(
        "gid", F.col("id").alias("_old"), "_new")
    s = m.select("gid", F.col("_old").alias("src"), F.col("_new").alias("_nsrc"))
    d = m.select("gid", F.col("_old").alias("dst"), F.col("_new").alias("_ndst"))
    e = stacked.edges.join(s, ["gid", "src"]).join(d, ["gid", "dst"])
    if flip:
        f = F.col("gid").isin(list(flip))
        e = e.select(F.when(f, F.col("_ndst")).otherwise(F.col("_nsrc")).alias("src"),
                     F.when(f, F.col("_nsrc")).otherwise(F.col("_ndst")).alias("dst"), "weight")
    else:
        e = e.select(F.col("_nsrc").alias("src"), F.col("_ndst").alias("dst"), "weight")
    e = e.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    if materialize:
        e = checkpoint(e)
    return e


def merge_many(graphs: list[Graph], reverse: bool = False) -> Graph:
    """Merge graphs by label (see ``merge_stacked``).

    ``reverse=True`` gives the edge directions of the pairwise fold
    ``merge(g_n, ... merge(g_3, merge(g_1, g_2)))`` with (dst, src)-keyed
    reduction, without running the fold.
    """
    flip = None
    if reverse:
        flip = {i for i, k in enumerate(fold_flips(len(graphs))) if k % 2 == 1}
    return merge_stacked(stack(graphs), flip)


def merge_graphs(g1: Graph, g2: Graph, reverse: bool = False) -> Graph:
    return merge_many([g1, g2], reverse)
