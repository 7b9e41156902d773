"""Line files: vertex files ("id label") and edge files ("src dst").

A line with a bad id or too few fields goes to a reject table
(``try_cast`` / ``get`` return null); building a graph writes that table
or fails.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.tokens import blank_split
from tagloom.operators.counting import line_count
from tagloom.operators.graph import Graph, attach_labels, from_edges
from tagloom.session import checkpoint


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-per-record text file(s) -> ``value STRING``."""
    return spark.read.text(path)


def _fields(lines: DataFrame, text_col: str) -> DataFrame:
    return lines.withColumn("_f", blank_split(text_col))


def parse_vertices(lines: DataFrame, text_col: str = "value") -> Parsed:
    """``"id label ..."`` -> ``(id BIGINT, label STRING)``; extra fields ignored."""
    f = _fields(lines, text_col).select(
        F.col(text_col).alias("line"),
        F.expr("try_cast(get(_f, 0) as bigint)").alias("id"),
        F.get(F.col("_f"), 1).alias("label"))
    ok = F.col("id").isNotNull() & F.col("label").isNotNull()
    return Parsed(f.filter(ok).select("id", "label"), f.filter(~ok).select("line"))


def parse_edges(lines: DataFrame, text_col: str = "value", keep: list | None = None) -> Parsed:
    """``"src dst ..."`` -> ``(src BIGINT, dst BIGINT)``."""
    keep = keep or []
    f = _fields(lines, text_col).select(
        *keep, F.col(text_col).alias("line"),
        F.expr("try_cast(get(_f, 0) as bigint)").alias("src"),
        F.expr("try_cast(get(_f, 1) as bigint)").alias("dst"))
    ok = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return Parsed(f.filter(ok).select(*keep, "src", "dst"), f.filter(~ok).select("line"))


def edges_from_lines(lines: DataFrame, num: int, raw_line: bool = False,
                     text_col: str = "value") -> Parsed:
    """Weighted edges from an occurrence file, weight = occurrences > ``num``.

    By default occurrences are keyed on the parsed (src, dst). With
    ``raw_line=True`` the raw line is the key, so ``"1 2"`` and
    ``"1 2 x"`` stay two parallel edges.
    """
    if raw_line:
        counted = line_count(lines, num, text_col, "weight")
        p = parse_edges(counted, text_col, keep=["weight"])
        return Parsed(p.rows.select("src", "dst", "weight"), p.rejects)
    p = parse_edges(lines, text_col)
    edges = (p.rows.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
             .filter(F.col("weight") > F.lit(num)))
    return Parsed(edges, p.rejects)


class RejectedLines(ValueError):
    """Lines that could not be parsed, when no place for them was given."""


def graph_from_lines(vertex_lines: DataFrame, edge_lines: DataFrame, num: int,
                     raw_line: bool = False, materialize: bool = True,
                     rejects: str | None = None) -> Graph:
    """Vertex lines + edge occurrence lines -> thresholded, labelled graph.

    Lines that cannot be parsed are written to the folder ``rejects``
    (``kind=vertex`` and ``kind=edge``); without it any such line raises
    ``RejectedLines``. The thresholded edges are checkpointed
    (``materialize``): the vertex set and every later view read them
    instead of re-counting the lines.
    """
    v, e = parse_vertices(vertex_lines), edges_from_lines(edge_lines, num, raw_line)
    bad = (v.rejects.select(F.lit("vertex").alias("kind"), "line")
           .unionAll(e.rejects.select(F.lit("edge").alias("kind"), "line")))
    if rejects is not None:
        bad.write.mode("overwrite").partitionBy("kind").text(rejects)
    else:
        first = bad.take(1)
        if first:
            raise RejectedLines(f"{first[0]['kind']} line cannot be parsed: {first[0]['line']!r}")
    edges = checkpoint(e.rows) if materialize else e.rows
    return Graph(attach_labels(from_edges(edges), v.rows), edges)


def graph_from_files(spark: SparkSession, vertex_path: str, edge_path: str, num: int,
                     raw_line: bool = False, rejects: str | None = None) -> Graph:
    """Vertex file + edge occurrence file -> thresholded, labelled graph."""
    return graph_from_lines(read_lines(spark, vertex_path), read_lines(spark, edge_path),
                            num, raw_line, rejects=rejects)
