"""Exact cosine links between embeddings by cover-tree dual traversal.

Distances are Euclidean between normalised vectors (double precision), so
cosine >= c is distance <= sqrt(2 - 2c). Equal vectors are one class.

The upper tree is built by Spark: a cell of more than ``CELL`` classes is
split among centres drawn from it (at most ``FANOUT``), and each child
keeps its covering radius, measured over all its members. Vectors stay
where they are meanwhile: tasks find the cell of each by walking down the
centres known so far (one in about ``SPLIT`` vectors), and only numbers are
shuffled. The traversal starts with the pair (root, root) and replaces
pairs by the pairs of their children, an equi-join a level; a pair is
pruned if the distance of its centres exceeds both radii plus the threshold.

Every leaf cell gets a cover tree in numpy, once (nested levels whose radii
halve). Cells are dealt to groups, and a task streams the pairs of cells of
two groups, which it reads from the one shuffle by group: no cell is
written once per pair or per partner, so disk grows with the vectors, not
with the pairs. A pair's trees are walked together with the same bound;
leaves are compared by matrix products. It returns link
counts per class and the edges of a spanning forest, so the number of
linked pairs is never a number of rows.

Vectors are stored in the type of the column (float or double), in the
input's scale, and normalised wherever they are used.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm import common
from tagloom.llm.components import components
from tagloom.llm.tokens import released
from tagloom.session import arrow_bytes

COSINE = 0.95
CELL = 4096                 # classes of a leaf cell
SPLIT = 2048                # classes a new cell should have
FANOUT = 64
LEAF = 48                   # vectors of a leaf in the numpy trees
BLOCK = 1024                # vectors assigned to centres together
GROUP = 4                   # leaf cells of a group, as long as there are few groups
GROUPS = 32                 # groups, as long as they are small
GROUP_BYTES = 32 << 20      # a group's vectors; a task holds one group and one cell more
PAIR_BYTES = 8 << 20        # cells given to Python together
HEAD = 24                   # components of the products that are made first
TILE = 1 << 18              # products made at a time
_SLACK = 1e-6               # distances near zero are good to about 1e-8 only, the more so the longer the vectors
_HEAD_SLACK = 1e-5          # products of heads are single precision
_ROOT_RADIUS = 2.0


def _vectors(raw: list[bytes], kind=np.float64) -> np.ndarray:
    """Normalised rows of stored vectors (all of one length)."""
    return _normal(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))


def _normal(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)           # no overflow or underflow in the norm
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


# --- numpy cover tree -------------------------------------------------------------

class Tree:
    """Cover tree over the rows of ``x``, which it puts in its own order.

    Node i covers rows ``lo[i]`` to ``hi[i]``; its centre is row ``lo[i]``,
    all its rows lie within ``radius[i]`` of it, and its children are nodes
    ``first[i]`` to ``end[i]`` (none: a leaf). Node 0 is the root.
    """

    def __init__(self, x, order, lo, hi, radius, first, end):
        self.x, self.order = x, order
        self.lo, self.hi, self.radius, self.first, self.end = lo, hi, radius, first, end
        self.center = x[lo]
        self.leaf = first == end
        self._head = None

    @property
    def head(self) -> np.ndarray:
        """The first ``HEAD`` components of each row and the norm of the
        others: the products of two such rows bound those of the rows."""
        if self._head is None:
            rest = np.linalg.norm(self.x[:, HEAD:], axis=1)
            self._head = np.concatenate([self.x[:, :HEAD], rest[:, None]], axis=1).astype(np.float32)
        return self._head

    @classmethod
    def build(cls, x: np.ndarray) -> "Tree":
        """Each node's children are a net of half the level's radius; rows
        that such a net does not gather stay together in one leaf."""
        order = np.arange(len(x))
        nodes = [[0, len(x), 0.0, 0, 0]]
        levels = [2.0]
        i = 0
        while i < len(nodes):
            lo, hi = nodes[i][:2]
            rows, level = order[lo:hi].copy(), levels[i]
            d = _distance(x[rows], x[rows[:1]])[:, 0]
            nodes[i][2] = radius = float(d.max())
            while level / 2 >= radius > 0:
                level /= 2
            if len(rows) > LEAF and radius > 0:
                half, rest, parts = level / 2, rows, []
                while len(rest):
                    near = d <= half if not parts else _distance(x[rest], x[rest[:1]])[:, 0] <= half
                    near[0] = True
                    parts.append(rest[near])
                    rest = rest[~near]
                    if len(parts) % 32 == 0 and len(rows) - len(rest) < 2 * len(parts):
                        break
                if len(rest):       # the net gathers next to nothing
                    single = [p for p in parts if len(p) == 1]
                    left, alone = np.concatenate([*single, rest]), len(parts[0]) == 1
                    parts = [p for p in parts if len(p) > 1]
                    # rows[0] is the centre of this node: its part stays the first
                    parts = [left, *parts] if alone else [*parts, left]
                if len(parts) > 1:
                    nodes[i][3], nodes[i][4] = len(nodes), len(nodes) + len(parts)
                    order[lo:hi] = np.concatenate(parts)
                    for p in parts:
                        nodes.append([lo, lo + len(p), 0.0, 0, 0])
                        levels.append(half)
                        lo += len(p)
            i += 1
        lo, hi, radius, first, end = (np.array(c) for c in zip(*nodes, strict=True))
        return cls(x[order], order, lo, hi, radius, first, end)

    def dump(self) -> bytes:
        table = np.stack([self.lo, self.hi, self.first, self.end]).astype(np.int64)
        return np.int64(len(self.lo)).tobytes() + table.tobytes() + self.radius.tobytes()

    @classmethod
    def load(cls, x: np.ndarray, data: bytes) -> "Tree":
        """The tree of rows that are already in its order."""
        n = int(np.frombuffer(data, np.int64, 1)[0])
        lo, hi, first, end = np.frombuffer(data, np.int64, 4 * n, 8).reshape(4, n)
        return cls(x, None, lo, hi, np.frombuffer(data, np.float64, n, 8 + 32 * n), first, end)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _block_links(a: Tree, lo: int, hi: int, b: Tree, q: np.ndarray, cosine: float):
    """(row of ``a`` from ``lo`` to ``hi``, place in ``q``) arrays of linked
    vectors, some rows at a time. Where the products of the heads leave few
    rows, only those are compared whole."""
    other, heads = b.x[q].T, b.head[q].T
    step = max(16, TILE // max(len(q), 1))
    for at in range(lo, hi, step):
        x = a.x[at:min(at + step, hi)]
        near, k = None, None
        if x.shape[1] > HEAD:
            hit = a.head[at:at + len(x)] @ heads >= np.float32(cosine - _HEAD_SLACK)
            if not hit.any():
                continue
            near = np.flatnonzero(hit.any(axis=1))
            if 4 * len(near) > len(x):
                near = None
        if near is None:
            i, k = np.nonzero(x @ other >= cosine)
        else:
            i, k = np.nonzero(x[near] @ other >= cosine)
            i = near[i]
        if len(i):
            yield i + at, k


def dual_links(a: Tree, b: Tree, cosine: float):
    """(rows of a, rows of b) arrays of linked vectors."""
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    stack = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        left, right = stack.pop()
        d = _distance(a.center[left], b.center[right])
        d -= a.radius[left][:, None]
        d -= b.radius[right]
        i, j = np.nonzero(d <= reach)
        cut = np.flatnonzero(np.diff(i)) + 1
        for part in np.split(np.arange(len(i)), cut):
            if not len(part):
                continue
            n, others = int(left[i[part[0]]]), right[j[part]]
            leaf = b.leaf[others]
            leaves, inner = others[leaf], others[~leaf]
            below = np.array([n]) if a.leaf[n] else np.arange(a.first[n], a.end[n])
            if len(leaves) and not a.leaf[n]:
                stack.append((below, leaves))
            elif len(leaves):
                q = _ranges(b.lo[leaves], b.hi[leaves])
                for p, k in _block_links(a, int(a.lo[n]), int(a.hi[n]), b, q, cosine):
                    yield p, q[k]
            if len(inner):
                stack.append((below, _ranges(b.first[inner], b.end[inner])))


# --- Spark -------------------------------------------------------------------------

def classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, type]:
    """(``vec_id, class`` of every row, one row per class, type of the
    stored numbers): ``class`` is a hash of the vector's length and scaled
    doubles, null for unusable vectors."""
    single = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType(), vectors.schema[vector_col].dataType.containsNull)
    kind, stored = (np.float32, "array<float>") if single else (np.float64, "array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(stored).alias("v"))

    def run(with_raw):
        def of(batches):
            for b in released(batches):
                keys, raws = [], []
                for v in b.column(1):
                    raw = key = None
                    if v.is_valid and len(v) and v.values.null_count == 0:
                        a = v.values.to_numpy()
                        with np.errstate(over="ignore"):
                            usable = bool(np.isfinite(a).all()) and bool(a.any())
                        if usable:
                            raw = a.tobytes()
                            a = a.astype(np.float64)
                            key = xxhash.xxh3_128_digest((a / np.abs(a).max()).tobytes())
                    keys.append(key)
                    raws.append(raw)
                cols = [b.column(0), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols[:2 + with_raw], names=["vec_id", "class", "raw"][:2 + with_raw])
        return of

    # the vectors are read twice and stored once, with their class
    keyed = common.written(rows.mapInArrow(run(False), "vec_id long, class binary"), "vec-rows")
    one = (rows.mapInArrow(run(True), "vec_id long, class binary, raw binary").filter("class is not null").groupBy("class")
           .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("raw").alias("raw"))
           .withColumn("cid", F.monotonically_increasing_id()))
    return keyed, common.written(one, "vec-classes"), kind


def _placed(centers: dict, kind, with_raw: bool):
    """The cells of classes: each walks from the root of its length to the
    nearest of a cell's centres, as far as ``centers`` go (cell: centres and
    children), with its distance to the last one."""
    def place(cell: int, x: np.ndarray):
        at, dist = np.full(len(x), cell, np.int64), np.full(len(x), _ROOT_RADIUS)
        open_ = [(cell, np.arange(len(x)))]
        while open_:
            cell, rows = open_.pop()
            if cell not in centers:
                continue
            c, child = centers[cell]
            d = _distance(x[rows], c)
            near = d.argmin(axis=1)
            at[rows], dist[rows] = child[near], d[np.arange(len(rows)), near]
            open_ += [(int(child[i]), rows[near == i]) for i in np.unique(near).tolist()]
        return at, dist

    def run(batches):
        for whole in released(batches):
            for lo in range(0, whole.num_rows, BLOCK):
                b = whole.slice(lo, BLOCK)
                raw = b.column(2).to_pylist()
                cell, dist = -np.array([len(r) for r in raw], np.int64), np.zeros(len(raw))
                for root in np.unique(cell).tolist():
                    rows = np.flatnonzero(cell == root)
                    cell[rows], dist[rows] = place(root, _vectors([raw[i] for i in rows.tolist()], kind))
                placed = [pa.array(cell), pa.array(dist)]
                yield (pa.RecordBatch.from_arrays([*b.columns, placed[0]], names=["cid", "copies", "raw", "cell"]) if with_raw else
                       pa.RecordBatch.from_arrays([b.column(0), *placed], names=["cid", "cell", "dist"]))
    return run


def upper_tree(one: DataFrame, kind=np.float64) -> tuple[DataFrame, DataFrame]:
    """(``cid, copies, raw, cell`` of every class, ``node, parent, center,
    radius, leaf``). Vectors of different lengths start in different cells
    (a root per length). The centres pass through the driver and go to the
    tasks: one of about ``SPLIT`` vectors."""
    vectors, centers = one.select("cid", "copies", "raw"), {}
    sizes = (one.select((-F.length("raw")).cast("long").alias("cell"), "raw").groupBy("cell")
             .agg(F.count(F.lit(1)).alias("n"), F.first("raw").alias("center")))
    nodes = [common.written(sizes.select(F.col("cell").alias("node"), F.lit(None).cast("long").alias("parent"), "center",
                                         F.lit(_ROOT_RADIUS).alias("radius"), "n"), "vec-node")]
    place = "cid long, cell long, dist double"
    while True:
        members = common.written(vectors.mapInArrow(_placed(centers, kind, False), place), "vec-cell")
        if centers:
            child = members.groupBy("cell").agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n"))
            nodes.append(common.written(chosen.join(child, "cell").select(
                F.col("cell").alias("node"), "parent", "center", "radius", "n"), "vec-node"))
        large = nodes[-1].filter(F.col("n") > CELL).select(
            F.col("node").alias("cell"), F.least(F.lit(FANOUT), F.ceil(F.col("n") / SPLIT)).alias("k"))
        large = common.written(large, "vec-large")
        if large.isEmpty():
            break
        order = Window.partitionBy("cell").orderBy(F.xxhash64("cid"), "cid")
        drawn = (members.join(large, "cell").withColumn("i", F.row_number().over(order)).filter(F.col("i") <= FANOUT)
                 .filter(F.col("i") <= F.col("k")).select("cid", F.col("cell").alias("parent"), "i"))
        drawn = common.written(drawn, "vec-drawn")
        chosen = common.written(vectors.join(drawn, "cid").select(
            _child_id(F.col("parent"), F.col("i")).alias("cell"), "parent", "i", F.col("raw").alias("center")), "vec-centers")
        for parent, some in groupby(chosen.orderBy("parent", "i").collect(), lambda r: r["parent"]):
            some = list(some)
            centers[parent] = _vectors([r["center"] for r in some], kind), np.array([r["cell"] for r in some], np.int64)
    all_nodes = nodes[0]
    for more in nodes[1:]:
        all_nodes = all_nodes.unionAll(more)
    tree = common.written(all_nodes.withColumn("leaf", F.col("n") <= CELL).drop("n"), "vec-tree")
    return vectors.mapInArrow(_placed(centers, kind, True), "cid long, copies long, raw binary, cell long"), tree


def _child_id(parent, i):
    """Ids of different nodes differ (64-bit hash of the path)."""
    return F.shiftrightunsigned(F.xxhash64(parent, i.cast("int")), 1)


def cell_pairs(tree: DataFrame, cosine: float, kind=np.float64) -> DataFrame:
    """``a, b`` (a <= b): leaf cells that may hold linked vectors."""
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    near_schema = "a long, b long, leaf_a boolean, leaf_b boolean"

    def near(batches):
        for b in released(batches):
            if not b.num_rows:
                continue
            x, y = (b.column(i).to_pylist() for i in (2, 3))
            d = np.array([_distance(_vectors([p], kind), _vectors([q], kind))[0, 0] for p, q in zip(x, y, strict=True)])
            ok = pa.array(d <= np.asarray(b.column(4)) + reach)
            yield pa.RecordBatch.from_arrays([b.column(i).filter(ok) for i in (0, 1, 5, 6)],
                                             names=["a", "b", "leaf_a", "leaf_b"])

    # what a node is replaced by: its children, a leaf by itself
    below = common.written(
        tree.filter("parent is not null").select(F.col("parent").alias("of"), "node", "center", "radius", "leaf")
        .unionAll(tree.filter("leaf").select(F.col("node").alias("of"), "node", "center", "radius", "leaf")), "vec-below")
    pairs = tree.filter("parent is null").select(F.col("node").alias("a"), F.col("node").alias("b"),
                                                 F.col("leaf").alias("leaf_a"), F.col("leaf").alias("leaf_b"))
    pairs = common.written(pairs, "vec-pairs")
    done = pairs.filter("leaf_a and leaf_b")
    while True:
        open_ = pairs.filter("not (leaf_a and leaf_b)").select("a", "b")
        if open_.isEmpty():
            return done.select("a", "b")
        left = below.select(F.col("of").alias("a"), F.col("node").alias("na"), F.col("center").alias("ca"),
                            F.col("radius").alias("ra"), F.col("leaf").alias("la"))
        right = below.select(F.col("of").alias("b"), F.col("node").alias("nb"), F.col("center").alias("cb"),
                             F.col("radius").alias("rb"), F.col("leaf").alias("lb"))
        both = (open_.join(left, "a").join(right, "b").filter("a != b or na <= nb")
                .select("na", "nb", "ca", "cb", F.col("ra") + F.col("rb"), "la", "lb"))
        pairs = common.written(both.mapInArrow(near, near_schema), "vec-pairs")
        done = done.unionAll(pairs.filter("leaf_a and leaf_b"))


CELL_SCHEMA = "cell long, cids binary, copies binary, x binary, tree binary, partners array<long>"


def _planted(kind):
    """Leaf cells with their cover trees, built once per cell."""
    def run(batches):
        for b in released(batches):
            for i, m in enumerate(b.column(1)):
                cids, copies, raw = (m.values.field(k) for k in range(3))
                tree = Tree.build(_vectors(raw.to_pylist(), kind))
                ids, n = (c.to_numpy(zero_copy_only=False).astype(np.int64)[tree.order].tobytes() for c in (cids, copies))
                x = b"".join(raw.take(pa.array(tree.order)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), *(pa.array([c], pa.binary()) for c in (ids, n, x, tree.dump())), b.column(2).slice(i, 1)],
                    names=["cell", "cids", "copies", "x", "tree", "partners"])
    return run


def _compare(cosine: float, kind):
    def side(c):
        cids = np.frombuffer(c["cids"].as_py(), np.int64)
        x = _normal(np.frombuffer(c["x"].as_py(), kind).reshape(len(cids), -1))
        return cids, np.frombuffer(c["copies"].as_py(), np.int64), Tree.load(x, c["tree"].as_py())

    def run(batches):
        held, left = None, None
        for b in released(batches):
            out_x, out_y, out_n = [], [], []
            for xs, ys in zip(b.column(0), b.column(1), strict=True):
                if held != xs["cell"].as_py():      # the pairs of a cell come together
                    held, left = xs["cell"].as_py(), side(xs)
                same = held == ys["cell"].as_py()
                cx, mx, tx = left
                cy, my, ty = left if same else side(ys)
                nx, ny = np.zeros(len(cx), np.int64), np.zeros(len(cy), np.int64)
                every = cx if same else np.concatenate([cx, cy])
                parent = np.arange(len(every))
                for i, j in dual_links(tx, ty, cosine):
                    if same:
                        keep = i < j            # the pair of a cell with itself meets each link twice
                        i, j = i[keep], j[keep]
                    nx += np.bincount(i, my[j], len(nx)).astype(np.int64)
                    ny += np.bincount(j, mx[i], len(ny)).astype(np.int64)
                    for p, q in zip(i.tolist(), (j if same else j + len(cx)).tolist(), strict=True):
                        while parent[p] != p:
                            parent[p] = parent[parent[p]]
                            p = parent[p]
                        while parent[q] != q:
                            parent[q] = parent[parent[q]]
                            q = parent[q]
                        if p != q:
                            parent[max(p, q)] = min(p, q)
                            out_x.append(int(every[p]))
                            out_y.append(int(every[q]))
                            out_n.append(0)
                for c, n in ((cx, nx), (cy, ny)):
                    at = np.flatnonzero(n)
                    out_x += c[at].tolist()
                    out_y += [None] * len(at)
                    out_n += n[at].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_x, pa.int64()), pa.array(out_y, pa.int64()),
                                              pa.array(out_n, pa.int64())], names=["x", "y", "n"])
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id`` of every row.

    Two rows are linked if their vectors have the same length and a cosine
    of at least ``cosine``. Null, empty and zero vectors and those with a
    null, NaN or infinite component are linked with nothing. Repeated rows
    and equal vectors are linked to each other. ``component_id`` is the
    least vec_id reachable (null ids are passed over). An empty table has
    no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    keyed, one, kind = classes(vectors, id_col, vector_col)
    cells, tree = upper_tree(one, kind)
    pairs = common.written(cell_pairs(tree, cosine, kind), "vec-cell-pairs")
    partners = common.written(pairs.groupBy(F.col("a").alias("cell")).agg(F.sort_array(F.collect_list("b")).alias("partners")),
                              "vec-partners")
    size = one.agg(F.sum(F.length("raw")).alias("bytes")).first()["bytes"] or 0
    few = min(GROUPS, -(-tree.filter("leaf").count() // GROUP))
    groups = max(1, few, -(-size // GROUP_BYTES))
    held = (cells.groupBy("cell").agg(F.collect_list(F.struct("cid", "copies", "raw")).alias("m"))
            .join(partners, "cell").mapInArrow(_planted(kind), CELL_SCHEMA)
            .select(F.struct("cell", "cids", "copies", "x", "tree", "partners").alias("side")))
    held = held.repartitionById(groups, F.pmod(F.xxhash64("side.cell"), F.lit(groups)).cast("int"))
    # neither side gets a filter of its own (for nulls), so one shuffle serves both
    linked = F.coalesce(F.array_contains("xs.partners", F.col("ys.cell")), F.lit(False))
    both = (held.select(F.col("side").alias("xs")).hint("shuffle_replicate_nl")
            .join(held.select(F.col("side").alias("ys")), linked))
    with arrow_bytes(spark, PAIR_BYTES):
        found = common.written(both.mapInArrow(_compare(cosine, kind), "x long, y long, n long"), "vec-found")
    counts = found.filter("y is null").groupBy(F.col("x").alias("cid")).agg(F.sum("n").alias("n"))
    comp = common.written(components(found.filter("y is not null"), "x", "y"), "vec-comp")
    of = common.written(one.select("cid", "class", "copies", "least")
                        .join(comp.withColumnRenamed("id", "cid"), "cid", "left").join(counts, "cid", "left")
                        .select("class", F.coalesce("component", "cid").alias("component"), "least",
                                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vec-of")
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = common.written(of.join(least, "component").select("class", "n_links", "component_id"), "vec-named")
    return (keyed.join(named, "class", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")))
