"""Connected components by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Each step joins a table of edges with one minimum per vertex. A vertex of
very many edges is a hot join key on the edge side only. Both sides are
written first, so they are plain scans: a small side is broadcast after
its real size is known, and otherwise both sides are shuffled for the join
alone, where adaptive execution splits the hot partition.

Rounds are preceded by contractions (``local_stars``): tasks reduce their
edges, block by block, to one star per local component, dealt anew by
member as long as that halves them. Edges that fit one block need no round,
so few small tables are written and the driver plans few jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tagloom.llm import common
from tagloom.operators.components import BLOCK_EDGES, local_stars


def _large_star(e: DataFrame) -> DataFrame:
    """Every neighbour v > u of u is linked to the least of u and its
    neighbours."""
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = common.written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v")


def _small_star(e: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of these."""
    down = e.select(F.col("v").alias("x"), F.col("u").alias("y"))
    least = common.written(down.groupBy("x").agg(F.min("y").alias("m")), "cc-least")
    linked = (down.join(least, "x").select(F.col("y").alias("a"), "m")
              .unionAll(least.select(F.col("x").alias("a"), "m")))
    return (linked.filter("a != m").select(F.least("a", "m").alias("u"), F.greatest("a", "m").alias("v"))
            .distinct())


def _counted(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges with their count and the sum of their hashes."""
    obs = Observation()
    out = common.written(e.observe(obs, F.count(F.lit(1)).alias("n"),
                                   F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "cc-edges")
    return out, (obs.get["n"], obs.get["h"])


def _contracted(e: DataFrame, block_edges: int) -> tuple[DataFrame, tuple, bool]:
    """The edges as stars of what tasks hold, their count and sum of hashes,
    and whether one block held them all (then nothing is left to join)."""
    e, seen = _counted(local_stars(e, block_edges))
    while seen[0]:
        before, whole = seen[0], seen[0] <= block_edges
        dealt = e.coalesce(1) if whole else e.repartition(-(-before // block_edges), "v")
        e, seen = _counted(local_stars(dealt, block_edges))
        if whole or seen[0] * 2 > before:
            return e, seen, whole
    return e, seen, True


def components(edges: DataFrame, a: str = "a", b: str = "b", block_edges: int = BLOCK_EDGES) -> DataFrame:
    """``id, component`` of every vertex that has an edge to another one:
    the least id reachable. Edges are undirected; self-loops, repeated
    edges and edges with a null end are ignored. Ends when a round changes
    nothing (the number of rounds grows with the logarithm of the size);
    edges of long ids are contracted first, ``block_edges`` at a time."""
    e = edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    if all(isinstance(f.dataType, LongType) for f in e.schema):
        e, seen, done = _contracted(e, block_edges)
    else:
        (e, seen), done = _counted(e.distinct()), False
    while seen[0] and not done:
        # a large-star round's output is read twice by the small-star step
        e, now = _counted(_small_star(common.written(_large_star(e), "cc-large")))
        done, seen = now == seen, now
    return (e.select(F.col("v").alias("id"), F.col("u").alias("component"))
            .unionAll(e.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()))
