"""Merging graphs step by step with a stored label dictionary.

``merge_many`` numbers all labels anew. Here labels that are known keep
their ids, new ones get the ids after them in label order, and the edges of
a new graph are added to those already merged: work follows the new graph,
apart from one pass over the merged edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.graph import Graph
from tagloom.operators.indexing import dense_id
from tagloom.session import checkpoint


def extend_labels(known: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, label``: the dictionary ``known`` with the labels it lacks."""
    new = labels.select("label").distinct().join(known.select("label"), "label", "left_anti")
    first = known.agg(F.max("id")).first()[0]
    new = dense_id(new, ["label"], "_i").select((F.col("_i") + (0 if first is None else first + 1)).alias("id"), "label")
    return checkpoint(known.select("id", "label").unionByName(new))


def merge_into(merged: Graph, graph: Graph) -> Graph:
    """``merged`` (ids of its own, one per label) with ``graph`` added by
    label; parallel edges add their weights, equal labels of ``graph``
    become one vertex."""
    vertices = extend_labels(merged.vertices, graph.vertices)
    ids = graph.vertices.join(vertices.withColumnRenamed("id", "_new"), "label").select("id", "_new")
    edges = (graph.edges.join(ids.toDF("src", "_src"), "src").join(ids.toDF("dst", "_dst"), "dst")
             .select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight"))
    both = merged.edges.select("src", "dst", "weight").unionByName(edges)
    return Graph(vertices, checkpoint(both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))))
