"""GEXF 1.2 output, rendered on the executors.

``gexf_lines`` gives one row per output line with a sort key; writing it
sorted produces part files that, concatenated in name order, are the
document. No step gathers the graph in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.graph import Graph

# GEXF 1.2 document frame.
GEXF_HEAD = [
    '<?xml version="1.0" encoding="UTF-8"?>',
    '<gexf xmlns="http://www.gexf.net/1.2draft" version="1.2">',
    '<graph mode="static" defaultedgetype="directed">',
    '<nodes>',
]
GEXF_MIDDLE = ['</nodes>', '<edges>']
GEXF_TAIL = ['</edges>', '</graph>', '</gexf>']


def xml_escape(c: Column) -> Column:
    """Escape ``& < > "`` for an attribute value (``&`` first)."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _fixed(spark) -> DataFrame:
    """The frame lines as one literal table (built in the JVM, one row each)."""
    rows = [F.struct(F.lit(sec).alias("section"), F.lit(i).cast("bigint").alias("k1"),
                     F.lit(0).cast("bigint").alias("k2"), F.lit(text).alias("line"))
            for sec, lines in ((0, GEXF_HEAD), (2, GEXF_MIDDLE), (4, GEXF_TAIL))
            for i, text in enumerate(lines)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def gexf_lines(g: Graph) -> DataFrame:
    """``(section, k1, k2, line)``; ordering by the first three gives the file."""
    spark = g.vertices.sparkSession
    nodes = g.vertices.select(
        F.lit(1).alias("section"), F.col("id").alias("k1"), F.lit(0).cast("bigint").alias("k2"),
        F.concat(F.lit('<node id="'), F.col("id").cast("string"), F.lit('" label="'),
                 xml_escape(F.coalesce(F.col("label"), F.lit(""))), F.lit('" />')).alias("line"))
    edges = g.edges.select(
        F.lit(3).alias("section"), F.col("src").alias("k1"), F.col("dst").alias("k2"),
        F.concat(F.lit('<edge source="'), F.col("src").cast("string"), F.lit('" target="'),
                 F.col("dst").cast("string"), F.lit('" weight="'), F.col("weight").cast("string"),
                 F.lit('"/>')).alias("line"))
    return _fixed(spark).unionByName(nodes).unionByName(edges)


def write_gexf(g: Graph, path: str) -> None:
    """Write the document as ordered part files under ``path``."""
    (gexf_lines(g).orderBy("section", "k1", "k2", "line").select("line")
     .write.mode("overwrite").text(path))
