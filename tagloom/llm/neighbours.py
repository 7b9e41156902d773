"""Approximate nearest neighbours with balanced posting lists.

Largest inner product becomes nearest point on a sphere: vectors are scaled
by the largest norm and get one more component that brings them to length
one; queries are scaled to length one.

* A bounded sample (``SAMPLE`` vectors) is halved again and again between
  two means, at the median, so all lists have the same share of it; their
  means are the centroids, at most ``MAX_LISTS`` and ``MODEL_BYTES``.
* Centroids are searched by an in-memory graph (their nearest neighbours,
  made symmetric and connected), best first.
* Every vector goes to its nearest list, and to at most ``REPLICAS - 1``
  others whose distance is within ``BOUNDARY`` of the nearest one's. A list
  of more than ``PART`` vectors is dealt over several parts; a query meets
  all of them, so no list is cut.
* A query searches the lists whose distance is within a ratio of its
  nearest list's. The ratio is fitted: ``CHECKED`` queries are compared
  with all vectors, and the least ratio is taken that finds ``RECALL`` of
  their neighbours.

A query first meets the ``FIRST`` nearest of its lists, without replicas.
The worst of its ``k`` best there is a floor: no list returns less, so what
is found grows with the queries, not with the lists they search.

Equal vectors are one class, which is indexed and searched once. A task
holds one part of a list and meets queries batch by batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.tokens import released

K = 20
LIST = 256                  # vectors a list should have before replication
MAX_LISTS = 4096
MODEL_BYTES = 32 << 20      # of all centroids
SAMPLE = 1 << 16            # vectors the lists are fitted on, at most
REPLICAS = 4
BOUNDARY = 1.15
PART = 4096                 # classes of a list that a task holds
RECALL = 0.97
CHECKED = 200               # queries the search ratio is fitted on, at most
DEGREE = 8                  # neighbours of a centroid in the graph, before it is made symmetric
WIDTH = 16                  # centroids kept while a vector's lists are sought
ENTRIES = 8
BLOCK = 256                 # queries compared together
FIRST = 5                   # lists a query meets to find its floor


# --- index ----------------------------------------------------------------------

def halved(x: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` equal parts of ``x``: parts are halved between two
    means, at the median of the difference of their distances."""
    parts = [np.arange(len(x))]
    while len(parts) < lists:
        parts.sort(key=len)
        rows = parts.pop()
        if len(rows) < 2:
            parts.append(rows)
            break
        y = x[rows]
        far = y[np.argmax(((y - y[0]) ** 2).sum(axis=1))]
        two = np.stack([far, y[np.argmax(((y - far) ** 2).sum(axis=1))]])
        for _ in range(6):
            side = y @ (two[1] - two[0])
            order = np.argsort(side, kind="stable")
            low, high = order[:len(order) // 2], order[len(order) // 2:]
            two = np.stack([y[low].mean(axis=0), y[high].mean(axis=0)])
        parts += [rows[low], rows[high]]
    return np.stack([x[p].mean(axis=0) for p in parts]).astype(np.float32)


class Lists:
    """Centroids and their graph; ``graph[i]`` lists the neighbours of
    centroid i (filled up with i itself)."""

    def __init__(self, centers: np.ndarray, graph: np.ndarray):
        self.centers, self.graph = centers, graph
        self.squares = (centers * centers).sum(axis=1)
        self.entries = np.unique(np.linspace(0, len(centers) - 1, min(ENTRIES, len(centers))).astype(np.int64))

    @classmethod
    def build(cls, centers: np.ndarray) -> "Lists":
        n = len(centers)
        squares = (centers * centers).sum(axis=1)
        near = np.empty((n, min(DEGREE, n - 1)), np.int64)
        for i in range(0, n, 512):
            d = squares - 2 * (centers[i:i + 512] @ centers.T)
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            near[i:i + 512] = np.argsort(d, axis=1, kind="stable")[:, :near.shape[1]]
        links = [set(row) for row in near.tolist()]
        for i, row in enumerate(near.tolist()):
            for j in row:
                links[j].add(i)
        # parts of the graph that the first centroid does not reach are tied to it
        reached = np.zeros(n, bool)
        todo = [0]
        while todo or not reached.all():
            if not todo:
                out = np.flatnonzero(~reached)[0]
                d = squares - 2 * (centers @ centers[out])
                d[~reached] = np.inf
                tie = int(np.argmin(d))
                links[tie].add(int(out))
                links[int(out)].add(tie)
                todo = [int(out)]
            i = todo.pop()
            if not reached[i]:
                reached[i] = True
                todo += [j for j in links[i] if not reached[j]]
        width = max(map(len, links), default=0)
        graph = np.repeat(np.arange(n)[:, None], max(width, 1), axis=1)
        for i, row in enumerate(links):
            graph[i, :len(row)] = sorted(row)
        return cls(centers, graph)

    def distances(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distances of each row of ``q`` to its row of centroids."""
        dots = np.einsum("ad,ard->ar", q, self.centers[at])
        return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + self.squares[at] - 2 * dots, 0))

    def nearest(self, q: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of about the ``width`` nearest centroids of
        each row, nearest first: best-first search that keeps ``width``."""
        n, rows = len(q), np.arange(len(q))
        seen = np.zeros((n, len(self.centers)), bool)
        at = np.repeat(self.entries[None], n, axis=0)
        seen[:, self.entries] = True
        d, open_ = self.distances(q, at), np.ones(at.shape, bool)
        while True:
            best = np.where(open_, d, np.inf).argmin(axis=1)
            go = rows[open_[rows, best]]
            if not len(go):
                break
            open_[go, best[go]] = False
            new = self.graph[at[go, best[go]]]
            fresh = ~seen[go[:, None], new]
            seen[go[:, None], new] = True
            nd = np.full((n, new.shape[1]), np.inf)
            nd[go] = np.where(fresh, self.distances(q[go], new), np.inf)
            na = np.zeros((n, new.shape[1]), np.int64)
            na[go] = new
            d, at = np.concatenate([d, nd], axis=1), np.concatenate([at, na], axis=1)
            open_ = np.concatenate([open_, np.isfinite(nd)], axis=1)
            if d.shape[1] > width:
                keep = np.argpartition(d, width - 1, axis=1)[:, :width]
                d, at, open_ = (np.take_along_axis(a, keep, axis=1) for a in (d, at, open_))
        order = np.argsort(d, axis=1, kind="stable")
        return np.take_along_axis(at, order, axis=1), np.take_along_axis(d, order, axis=1)

    def within(self, q: np.ndarray, ratio: float) -> list[np.ndarray]:
        """Centroids whose distance is at most ``ratio`` times the nearest
        one's, found from the nearest ones along the graph."""
        n = len(q)
        d = np.full((n, len(self.centers)), np.inf)
        at, near = self.nearest(q)
        rows = np.repeat(np.arange(n), at.shape[1]).reshape(at.shape)
        ok = np.isfinite(near)
        d[rows[ok], at[ok]] = near[ok]
        open_ = np.isfinite(d)
        limit = ratio * near[:, 0] + 1e-6
        while True:
            # every open centroid within the limit is expanded, all rows together
            r, c = np.nonzero(open_ & (d <= limit[:, None]))
            if not len(r):
                break
            open_[r, c] = False
            new = self.graph[c]
            r, new = np.repeat(r, new.shape[1]), new.ravel()
            unseen = ~np.isfinite(d[r, new])
            r, new = r[unseen], new[unseen]
            for i in range(0, len(r), 1 << 14):
                a, b = r[i:i + (1 << 14)], new[i:i + (1 << 14)]
                d[a, b] = self.distances(q[a], b[:, None])[:, 0]
            open_[r, new] = True
        return [np.flatnonzero(row <= lim) for row, lim in zip(d, limit, strict=True)]


def lists_of(model: Lists, x: np.ndarray) -> list[np.ndarray]:
    """The lists that hold each vector: its nearest one, and others within
    ``BOUNDARY`` of that distance."""
    at, d = model.nearest(x)
    ok = d[:, :REPLICAS] <= BOUNDARY * d[:, :1] + 1e-6
    return [row[k] for row, k in zip(at[:, :REPLICAS], ok, strict=True)]


# --- vectors ----------------------------------------------------------------------

class Space:
    """Vectors as points on the unit sphere: ``scale`` is the largest
    component, ``top`` the largest squared norm after scaling, ``dim`` the
    most components, ``kind`` the stored type (shorter vectors are filled with zeros; they are
    compared with vectors of their own length only)."""

    def __init__(self, scale: float, top: float, dim: int, kind: str):
        self.scale, self.top, self.dim, self.kind = scale, top, dim, kind

    def _padded(self, raw: list[bytes]) -> np.ndarray:
        x = np.zeros((len(raw), self.dim + 1))
        for i, r in enumerate(raw):
            v = np.frombuffer(r, self.kind)
            x[i, :len(v)] = v
        return x

    def points(self, raw: list[bytes]) -> np.ndarray:
        x = self._padded(raw) / self.scale
        x[:, -1] = np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))
        return (x / np.sqrt(self.top)).astype(np.float32)

    def queries(self, raw: list[bytes]) -> np.ndarray:
        x = self._padded(raw)
        x /= np.abs(x).max(axis=1, keepdims=True)
        return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _keyed(vectors: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """``vec_id, class, raw, high, sum`` of the usable rows: the class is a
    hash of the stored numbers (``kind``), ``high`` their largest size, ``sum`` the squared
    norm after division by it."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches):
        for b in released(batches):
            ids, raws, highs, sums = [], [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if i is None or not v.is_valid or not len(v) or v.values.null_count:
                    continue
                a = v.values.to_numpy() + 0.0               # -0.0 becomes 0.0
                high = float(np.abs(a).max())
                if not np.isfinite(high) or high == 0:
                    continue
                s = a / high
                ids.append(i)
                raws.append(a.astype(kind).tobytes())
                highs.append(high)
                sums.append(float(s @ s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([xxhash.xxh3_128_digest(r) for r in raws], pa.binary()),
                 pa.array(raws, pa.binary()), pa.array(highs, pa.float64()), pa.array(sums, pa.float64())],
                names=["vec_id", "class", "raw", "high", "sum"])

    return rows.mapInArrow(run, "vec_id long, class binary, raw binary, high double, sum double")


def _classes(keyed: DataFrame, k: int) -> DataFrame:
    """``cid, raw, high, sum, least, ids`` per class: ``ids`` are its k + 1
    least vec_ids, ``least`` the first of them."""
    part = Window.partitionBy("class", F.pmod(F.xxhash64("vec_id"), F.lit(32))).orderBy("vec_id")
    ids = (keyed.select("class", "vec_id").distinct().withColumn("i", F.row_number().over(part))
           .filter(F.col("i") <= F.lit(k + 1)).groupBy("class")
           .agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids")))
    one = keyed.groupBy("class").agg(F.first("raw").alias("raw"), F.max("high").alias("high"), F.max("sum").alias("sum"))
    return common.written(one.join(ids, "class").withColumn("cid", F.monotonically_increasing_id())
                          .withColumn("least", F.col("ids")[0]), "ann-classes")


def fit(one: DataFrame, n: int, space: Space) -> Lists:
    """The centroids and their graph, from at most ``SAMPLE`` classes (least
    hashes), in one task; the driver gets the model, of bounded size."""
    lists = max(1, min(n // LIST, MAX_LISTS, MODEL_BYTES // (4 * (space.dim + 1))))
    size = max(1, min(n, SAMPLE, 8 * MODEL_BYTES // (8 * (space.dim + 1))))
    share = min(1.0, 1.2 * size / n)
    place = F.pmod(F.xxhash64("class"), F.lit(1 << 30))
    sample = one.filter(place < int(share * (1 << 30)) + 1).select("class", "raw").limit(size)

    def run(batches):
        rows = sorted(r for b in released(batches) for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if rows:
            model = Lists.build(halved(space.points([r[1] for r in rows]), lists))
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.centers.tobytes()], pa.binary()), pa.array([model.graph.astype(np.int64).tobytes()], pa.binary())],
                names=["centers", "graph"])

    got = sample.repartition(1).mapInArrow(run, "centers binary, graph binary").collect()[0]
    centers = np.frombuffer(got["centers"], np.float32).reshape(-1, space.dim + 1)
    return Lists(centers, np.frombuffer(got["graph"], np.int64).reshape(len(centers), -1))


def assign(one: DataFrame, model: Lists, space: Space) -> DataFrame:
    """``cid, raw, least, list, home``: every class in each of its lists;
    ``home`` is the nearest."""
    shared = one.sparkSession.sparkContext.broadcast((model.centers, model.graph))

    def run(batches):
        m = Lists(*shared.value)
        for b in released(batches):
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                held = lists_of(m, space.points(part.column(1).to_pylist()))
                rows = part.take(pa.array(np.repeat(np.arange(len(held)), [len(h) for h in held])))
                home = np.concatenate([np.arange(len(h)) == 0 for h in held])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(held).astype(np.int32)), pa.array(home)],
                                                 names=["cid", "raw", "least", "list", "home"])

    return common.written(one.select("cid", "raw", "least").mapInArrow(
        run, "cid long, raw binary, least long, list int, home boolean"), "ann-lists")


# --- comparison -----------------------------------------------------------------------

def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner product of rows, summed in the same order whatever the block."""
    with np.errstate(all="ignore"):
        return np.einsum("ij,ij->i", x, y)


def best(q: np.ndarray, x: np.ndarray, least: np.ndarray, k: int, floor=-np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k rows of ``x`` with the largest inner
    product with each row of ``q``, ties to the smaller ``least``; none
    below the query's ``floor``."""
    with np.errstate(all="ignore"):
        s = q @ x.T
    s[np.isnan(s)] = -np.inf
    if s.shape[1] > k:
        cut = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    else:
        cut = np.full(len(s), -np.inf)
    cut = np.maximum(cut, floor)
    # a product may differ in its last digits from the sum below
    i, j = np.nonzero((s >= (cut - 1e-9 * np.abs(cut))[:, None]) | (s == cut[:, None]))
    score = _dots(q[i], x[j])
    ok = ~np.isnan(score)
    i, j, score = i[ok], j[ok], score[ok]
    order = np.lexsort((least[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    begin = np.searchsorted(i, np.arange(len(q)))
    keep = np.arange(len(i)) - begin[i] < k
    return i[keep], j[keep], score[keep]


FOUND = "query long, cid long, least long, score double"


def _found(query, cid, least, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(cid, pa.int64()), pa.array(least, pa.int64()),
                                       pa.array(score, pa.float64())], names=["query", "cid", "least", "score"])


def _by_length(raw: list[bytes], kind: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of doubles) of vectors of each length."""
    lens = np.array([len(r) for r in raw])
    return [(n, at, np.frombuffer(b"".join(raw[i] for i in at.tolist()), kind).astype(np.float64).reshape(len(at), -1))
            for n in np.unique(lens).tolist() for at in (np.flatnonzero(lens == n),)]


def exact(queries: DataFrame, one: DataFrame, k: int, kind: str) -> DataFrame:
    """``query, cid, least, score``: the k best classes of each of a few
    query classes (``cid, raw``, at most ``CHECKED``) among all."""
    asked = [(r["cid"], bytes(r["raw"])) for r in queries.select("cid", "raw").collect()]

    def run(batches):
        sides = {n: (at, q) for n, at, q in _by_length([r for _, r in asked], kind)}
        ids = np.array([c for c, _ in asked], np.int64)
        for b in released(batches):
            cid, least = np.asarray(b.column(0)), np.asarray(b.column(2))
            for n, at, x in _by_length(b.column(1).to_pylist(), kind):
                if n in sides:
                    i, j, s = best(sides[n][1], x, least[at], k)
                    yield _found(ids[sides[n][0][i]], cid[at[j]], least[at[j]], s)

    found = one.select("cid", "raw", "least").mapInArrow(run, FOUND)
    return _top(found, k)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "least")
    return (found.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= F.lit(k)).drop("i"))


def fitted_ratio(asked: DataFrame, one: DataFrame, held: DataFrame, model: Lists, space: Space, k: int,
                 recall: float = RECALL) -> float:
    """The least search ratio that reaches ``recall`` of the true neighbours
    of at most ``CHECKED`` queries. The driver gets their neighbours' lists."""
    few = common.written(asked.select("cid", "raw").orderBy(F.xxhash64("cid"), "cid").limit(CHECKED), "ann-checked")
    truth = common.written(exact(few, one, k + 1, space.kind).filter("query != cid").select("query", "cid"), "ann-truth")
    pairs = truth.join(held.select("cid", "list"), "cid").groupBy("query", "cid").agg(F.collect_list("list").alias("lists")).collect()
    if not pairs:
        return 1.0
    raw = {r["cid"]: bytes(r["raw"]) for r in few.collect()}
    ids = sorted(raw)
    q = space.queries([raw[i] for i in ids])
    d = np.sqrt(np.maximum(1 + model.squares - 2 * (q @ model.centers.T), 0))
    d = dict(zip(ids, d / np.maximum(d.min(axis=1, keepdims=True), 1e-9), strict=True))
    need = np.array([d[p["query"]][p["lists"]].min() for p in pairs])
    return float(max(1.0, np.quantile(need, recall, method="higher")))


def _sought(asked: DataFrame, model: Lists, space: Space, ratio: float) -> DataFrame:
    """``cid, raw, list, first``: the lists that each query class searches,
    and whether it is one of the ``FIRST`` nearest."""
    shared = asked.sparkSession.sparkContext.broadcast((model.centers, model.graph))
    few = FIRST

    def run(batches):
        m = Lists(*shared.value)
        for b in released(batches):
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                q = space.queries(part.column(1).to_pylist())
                lists = m.within(q, ratio)
                near = m.nearest(q)[0][:, :few]
                first = [np.isin(x, n) for x, n in zip(lists, near, strict=True)]
                rows = part.take(pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists])))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(lists).astype(np.int32)),
                                                  pa.array(np.concatenate(first))], names=["cid", "raw", "list", "first"])

    return common.written(asked.select("cid", "raw").mapInArrow(run, "cid long, raw binary, list int, first boolean"), "ann-sought")


def _compare(k: int, kind: str):
    def run(batches):
        now, cids, raws, leasts, sides = None, [], [], [], None
        for b in released(batches):
            lists, parts, asks = (np.asarray(b.column(i)) for i in range(3))
            cut = np.flatnonzero((np.diff(lists) != 0) | (np.diff(parts) != 0) | (np.diff(asks) != 0)) + 1
            for at in np.split(np.arange(b.num_rows), cut):
                if not len(at):
                    continue
                key, seg = (int(lists[at[0]]), int(parts[at[0]])), b.slice(int(at[0]), len(at))
                if key != now:
                    now, cids, raws, leasts, sides = key, [], [], [], None
                if not asks[at[0]]:                 # vectors of the part come before its queries
                    cids += seg.column(3).to_pylist()
                    raws += seg.column(4).to_pylist()
                    leasts += seg.column(5).to_pylist()
                    continue
                if sides is None:
                    ids, least = np.array(cids, np.int64), np.array(leasts, np.int64)
                    sides = {n: (ids[r], least[r], x) for n, r, x in _by_length(raws, kind)} if raws else {}
                asked, floor = np.asarray(seg.column(3)), np.asarray(seg.column(6))
                for n, r, q in _by_length(seg.column(4).to_pylist(), kind):
                    if n not in sides:
                        continue
                    c, least, x = sides[n]
                    for i in range(0, len(r), BLOCK):
                        p, j, s = best(q[i:i + BLOCK], x, least, k, floor[r[i:i + BLOCK]])
                        yield _found(asked[r[i + p]], c[j], least[j], s)
    return run


def _met(held: DataFrame, sought: DataFrame, parts: DataFrame, k: int, kind: str) -> DataFrame:
    """``query, cid, least, score``: what each query (``cid, raw, list,
    floor``) finds in the lists. A class that is found in several lists has
    the same score in each."""
    stored = (held.join(parts, "list")
              .select("list", F.pmod(F.xxhash64("cid"), "parts").cast("int").alias("part"), F.lit(0).alias("asks"),
                      "cid", "raw", "least", F.lit(0.0).alias("floor")))
    asks = (sought.join(parts, "list")
            .select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("asks"),
                    "cid", "raw", F.lit(0).cast("long").alias("least"), "floor"))
    return (stored.unionAll(asks).repartition(common.shuffle_partitions(held.sparkSession), "list", "part")
            .sortWithinPartitions("list", "part", "asks").mapInArrow(_compare(k, kind), FOUND)
            .groupBy("query", "cid", "least").agg(F.max("score").alias("score")))


def nearest(vectors: DataFrame, queries=None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: of every row that the condition
    ``queries`` (a column expression on vec_id; default: all rows) selects,
    the ``k`` other rows found with the largest inner product, nearest
    first, ties to the smaller vec_id.

    Null, empty and zero vectors, those with a null, NaN or infinite
    component, and rows with a null id take no part. Only vectors of the
    same length are compared; a pair whose product is not a number is none.
    Repeated rows (same id and vector) count once; rows with the query's id
    are no candidates of it. An empty table has no rows; other columns are
    not read. Scores are exact; which neighbours are found is approximate
    (``recall`` is what the search ratio is fitted to).
    """
    # floats are stored as they are; products are of doubles either way
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    keyed = common.written(_keyed(vectors, id_col, vector_col, kind), "ann-rows")
    one = _classes(keyed, k)
    n, scale, width = one.agg(F.count(F.lit(1)), F.max("high"), F.max(F.length("raw"))).first()
    asking = keyed if queries is None else keyed.filter(queries)
    asking = asking.select("class", F.col("vec_id").alias("query_id")).distinct()
    if not n:
        return keyed.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    top = one.agg(F.max(F.col("sum") * F.pow(F.col("high") / F.lit(scale), 2))).first()[0]
    space = Space(scale, top, width // np.dtype(kind).itemsize, kind)
    model = fit(one, n, space)
    held = assign(one, model, space)
    asking = common.written(asking.join(one.select("class", F.col("cid").alias("query")), "class").drop("class"), "ann-asking")
    asked = common.written(one.join(asking.select(F.col("query").alias("cid")).distinct(), "cid", "left_semi")
                           .select("cid", "raw"), "ann-asked")
    ratio = fitted_ratio(asked, one, held, model, space, k, recall)
    parts = common.written(held.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "ann-parts")
    sought = _sought(asked, model, space, ratio)
    no_floor = F.lit(float("-inf")).alias("floor")
    near = _met(held.filter("home"), sought.filter("first").select("cid", "raw", "list", no_floor), parts, k + 1, kind)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "least")
    floors = common.written(near.withColumn("i", F.row_number().over(order)).filter(F.col("i") == F.lit(k + 1))
                            .select(F.col("query").alias("cid"), F.col("score").alias("floor")), "ann-floors")
    sought = sought.join(floors, "cid", "left").select("cid", "raw", "list", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    found = common.written(_met(held, sought, parts, k + 1, kind), "ann-found")
    named = (_top(found, k + 1).join(one.select("cid", "ids"), "cid")
             .select("query", "score", F.explode("ids").alias("vec_id")))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = (named.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= F.lit(k + 1))
              .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("i", "vec_id", "score"))).alias("near")))
    return (asking.join(ranked, "query")
            .select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id").alias("vec_id"),
                    F.col("col.score").alias("score")))
