"""Weakly connected components with alternating large-star / small-star
rounds (Kiveris et al., "Connected Components in MapReduce and Beyond",
SoCC 2014), each round a few DataFrame aggregates and equi-joins.

Rounds are preceded by contractions: a task reduces its edges, block by
block, to one star per local component (``local_stars``), so an edge set
of any density leaves a task as at most one row per vertex it has seen.
The stars are dealt anew by their member and contracted again as long as
that halves them; the rounds then start from a near-forest, and an edge
set that fits one block needs no round at all.

Every round's edge set is checkpointed to the shared checkpoint folder:
lineage stays one round long and a lost executor recomputes at most one
round. The loop stops when a round leaves the edge set unchanged
(same row count and same sum of row hashes, observed while the
checkpoint is written). The component id of a
vertex is the least vertex id in its component.

Skew: a hub (in the end every component is a star around its least id)
is a hot join key on the edge side only; the other side holds one row per
vertex. That side is checkpointed before the join: as a plain scan it gets
a shuffle of its own, and only then does AQE split the hot partition (an
aggregate that is already partitioned on the key blocks it).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tagloom.operators.graph import Graph
from tagloom.operators.indexing import group_position
from tagloom.session import checkpoint

BLOCK_EDGES = 1 << 20       # edges contracted at a time; a block takes about 100 bytes an edge


def _undirected(edges: DataFrame) -> DataFrame:
    """(u, v) with u < v, no self-loops, no duplicates."""
    return (edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct())


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least vertex number of each vertex's component, for edges
    ``a[i]``-``b[i]`` among ``n`` vertices: roots hook onto smaller roots
    and chains are halved until no edge joins two roots."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def local_stars(e: DataFrame, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """Edges ``(u, v)`` as stars ``(least vertex, member)`` of each block of
    at most ``block_edges`` edges a task holds; the same components, and
    never more rows than edges. Memory: one block."""
    def run(batches):
        def stars(held):
            u = np.concatenate([x for x, _ in held])
            v = np.concatenate([y for _, y in held])
            ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            root = _roots(at[:len(u)], at[len(u):], len(ids))
            leaf = np.flatnonzero(root != np.arange(len(ids)))
            return pa.RecordBatch.from_arrays([pa.array(ids[root[leaf]]), pa.array(ids[leaf])], names=["u", "v"])

        held, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, block_edges):
                part = batch.slice(lo, block_edges)
                if held and n + part.num_rows > block_edges:
                    yield stars(held)
                    held, n = [], 0
                held.append(tuple(part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
                n += part.num_rows
        if held:
            yield stars(held)

    return e.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(run, "u long, v long")


def _large_star(e: DataFrame) -> DataFrame:
    """Link every neighbour v > u to m(u) = min(u, N(u))."""
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = checkpoint(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    # No distinct here: the output has at most one row per input edge, and
    # the small-star step (min, join, distinct) absorbs duplicates.
    return both.filter(F.col("v") > F.col("u")).join(m, "u").select(
        F.col("m").alias("u"), F.col("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """For each u, link u and its smaller neighbours to m(u) = min(N<(u) + u)."""
    down = e.select(F.col("v").alias("x"), F.col("u").alias("y"))   # x > y
    m = checkpoint(down.groupBy("x").agg(F.min("y").alias("m")))
    linked = (down.join(m, "x").select(F.col("y").alias("a"), "m")
              .unionAll(m.select(F.col("x").alias("a"), "m")))
    return (linked.filter(F.col("a") != F.col("m"))
            .select(F.least("a", "m").alias("u"), F.greatest("a", "m").alias("v")).distinct())


def _checkpoint(e: DataFrame) -> tuple[DataFrame, tuple]:
    """Checkpoint the edge set; its (row count, sum of row hashes) is
    observed by the same job, so no second pass reads it."""
    obs = Observation()
    c = checkpoint(e.observe(obs, F.count(F.lit(1)).alias("n"),
                             F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
    m = obs.get
    return c, (m["n"], m["h"])


def _is_star_forest(e: DataFrame) -> bool:
    """True when no vertex is both a root (u) and a leaf (v) and no leaf
    has two roots: then every component is a star around its least id,
    a fixed point of both steps. One aggregate (map-side combined, so a
    star centre folds to one row per task) instead of a confirming round."""
    ends = (e.select(F.col("u").alias("x"), F.lit(1).alias("r"), F.lit(0).alias("l"))
            .unionAll(e.select(F.col("v").alias("x"), F.lit(0).alias("r"), F.lit(1).alias("l"))))
    roles = ends.groupBy("x").agg(F.sum("r").alias("r"), F.sum("l").alias("l"))
    return roles.filter(((F.col("r") > 0) & (F.col("l") > 0)) | (F.col("l") > 1)).isEmpty()


def _contracted(edges: DataFrame, block_edges: int) -> tuple[DataFrame, tuple, bool]:
    """The edges contracted where they lie, then dealt by member and
    contracted again while that at least halves them, with their
    fingerprint and whether they are star-shaped already (one block held
    them all). A member has at most one row per block before it, so a hub
    or a giant component is no hot key."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = (edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
             .filter(F.col("u") != F.col("v")))
    e, fp = _checkpoint(local_stars(plain, block_edges))
    while fp[0]:
        n = min(parts, -(-fp[0] // block_edges))
        dealt = e.coalesce(1) if fp[0] <= block_edges else e.repartition(n, "v")
        before, whole = fp[0], fp[0] <= block_edges
        e, fp = _checkpoint(local_stars(dealt, block_edges))
        if whole or fp[0] * 2 > before:
            return e, fp, whole
    return e, fp, True


def star_edges(edges: DataFrame, max_rounds: int = 200, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """Contract (edges of long ids), then iterate to the fixed point:
    every component a star (root, member).

    ``max_rounds`` drops nothing: the rounds needed grow with the logarithm
    of the vertex count, and a run that exceeds the bound raises.

    Stops when a round changes nothing, or, once a round leaves the edge
    count unchanged, as soon as the edge set is a star forest.
    """
    if isinstance(edges.schema["src"].dataType, LongType) and isinstance(edges.schema["dst"].dataType, LongType):
        e, fp, done = _contracted(edges, block_edges)
        if done:
            return e
    else:
        e, fp = _undirected(edges), (None, None)   # round 1 reads the input directly
    for _ in range(max_rounds):
        e, nfp = _checkpoint(_small_star(checkpoint(_large_star(e))))
        if nfp == fp or (nfp[0] == fp[0] and _is_star_forest(e)):
            return e
        fp = nfp
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")


def connected_components(g: Graph, max_rounds: int = 200) -> DataFrame:
    """``(id, component)`` for every vertex of ``g``; an id without edges
    (or with self-loops only) is its own component."""
    stars = star_edges(g.edges, max_rounds)
    labels = stars.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return (g.vertices.select("id").distinct().join(labels, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def isolated_groups(components: DataFrame, max_members_per_line: int = 10000) -> DataFrame:
    """Members of each component as text lines, ids ascending, ``", "``-joined.

    One rule for every size: line ``chunk`` (0, 1, ...) holds the members
    at positions ``chunk * max_members_per_line`` onward, so lines follow
    each other in id order and no line is longer than the bound. Lines are
    formed on (component, chunk), which deals a giant component over many
    tasks.
    """
    placed = group_position(components.select("component", "id"), ["component"], ["id"], "_at")
    return (placed.groupBy("component", F.floor(F.col("_at") / F.lit(max_members_per_line)).cast("bigint").alias("chunk"))
            .agg(F.array_join(F.sort_array(F.collect_list("id")), ", ").alias("members")))
