"""MinHash near-duplicate detection.

A document's set is its distinct five-word shingles. Documents with equal
sets form a class; one row per class carries ``PERMS`` universal hash
minima. Bands of ``ROWS`` minima give candidates, candidates are verified
first on their signatures, then on their full sets (exactly), and the
verified links are closed into components by large-star / small-star.

Candidates without pairs inside a bucket: every member is compared with
its bucket's pivot (the least class). Linked classes share a component
from then on, and only buckets that still hold several components are
looked at again: there, members outside the bucket's largest component
meet all members, in blocks that are compared with numpy, so only links
between components become rows. A link can only be lost if no band of the
two documents agrees, which has a chance below 1e-7 at similarity 0.75.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.components import components
from tagloom.llm.tokens import released, small_batches
from tagloom.llm.words import shingles, word_hashes

WIDTH = 5
PERCENT = 75                # of the union that must be shared
BANDS, ROWS = 32, 3
PERMS = BANDS * ROWS
# Least signature agreement of a candidate that is verified exactly: five
# and a half standard deviations below 0.75.
SIGNATURE_LEAST = 0.5
BLOCK = 128                 # classes of a bucket compared side by side

_rng = np.random.default_rng(5)
_MULS = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDS = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + _rng.integers(0, 2, PERMS, dtype=np.uint64)

SKETCH_SCHEMA = "row long, n_shingles long, class binary, signature binary"


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text, A-Z lower-cased."""
    import pyarrow.compute as pc
    h, offs = word_hashes(pc.ascii_lower(texts))     # not after a cast: a cast slice lower-cases wrongly
    s, offs = shingles(h, offs, width)
    return [np.unique(s[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Universal hash minima of nonempty sets (u32, one row per set)."""
    out = np.empty((len(sets), PERMS), np.uint32)
    i = 0
    while i < len(sets):            # sets of about 64k values at a time, whole
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= 1 << 16):
            total += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        begin = np.cumsum([0] + [len(s) for s in sets[i:j - 1]])
        for k in range(PERMS):
            v = flat * _MULS[k]
            v += _ADDS[k]
            v >>= np.uint64(32)
            out[i:j, k] = np.minimum.reduceat(v, begin)
        i = j
    return out


def sketches(rows: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), width: int = WIDTH) -> DataFrame:
    """``keep`` columns, ``row``, ``n_shingles``, ``class`` (128-bit hash of
    the set; null if empty) and ``signature`` of every document of a
    numbered table."""
    rows = rows.select("row", F.col(text_col).alias("text"), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) if keep else ""

    def run(batches):
        for b in small_batches(batches):
            sets = shingle_sets(b.column(1), width)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = dict(zip(full, signatures([sets[i] for i in full]), strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([sig[i].astype("<u4").tobytes() if i in sig else None for i in range(len(sets))],
                          pa.binary()), *b.columns[2:]],
                names=["row", "n_shingles", "class", "signature", *keep])

    return rows.mapInArrow(run, f"{SKETCH_SCHEMA}{', ' + kept if kept else ''}")


def sets_of(rows: DataFrame, wanted: DataFrame, text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``row, set`` of the documents of a numbered table whose row is in
    ``wanted``: their texts are read again, so sets of other documents are
    never kept."""
    rows = rows.select("row", F.col(text_col).alias("text"))

    def run(batches):
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1), width)], pa.binary())],
                names=["row", "set"])

    return rows.join(wanted.hint("merge"), "row", "left_semi").mapInArrow(run, "row long, set binary")


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (x, y) whose signatures agree well enough."""
    sig = reps.select("cid", "signature")
    both = (pairs.join(sig.toDF("y", "sy"), "y").join(sig.toDF("x", "sx"), "x").select("x", "y", "sx", "sy"))

    def run(batches):
        for b in released(batches):
            sx, sy = (np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(-1, PERMS) for c in b.columns[2:])
            ok = (sx == sy).mean(axis=1) >= SIGNATURE_LEAST
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))],
                                             names=["x", "y"])

    return both.mapInArrow(run, "x long, y long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets share at least ``percent`` % of their union."""
    both = (pairs.join(sets.toDF("y", "set_y"), "y").join(sets.toDF("x", "set_x"), "x")
            .select("x", "y", "set_x", "set_y"))

    def run(batches):
        for b in released(batches):
            keep = [_share(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(b.column(2), b.column(3), strict=True)]
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["x", "y"])

    return both.mapInArrow(run, "x long, y long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """``row, doc_id, n_shingles, component, component_id`` of every document.

    Documents with equal sets, and documents whose sets share at least
    ``percent`` % of their union, are linked; ``component_id`` is the least
    doc_id reachable. A text without words has an empty set and is its own
    component (``component`` is null); one with fewer than ``width`` words has its whole sequence
    as the only shingle. Repeated rows are linked to each other (equal
    sets). Null ids are allowed: a component of them alone has a null id.
    An empty table has no rows. Rows are told apart by a number that is
    stored with them once.
    """
    rows = common.numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "minhash-rows")
    return _linked(rows, width, percent)


def _linked(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """``near_duplicates`` of a numbered table (``row, doc_id, text``)."""
    sketch = common.written(sketches(rows, "text", ("doc_id",), width), "minhash-sketch")
    # One class per distinct set; its least row stands for it.
    classes = common.written(
        sketch.filter("class is not null").groupBy("class").agg(F.min("row").alias("cid"),
                                                                F.min("doc_id").alias("least")), "minhash-class")
    reps = common.written(
        sketch.select(F.col("row").alias("cid"), "signature").join(classes.select("cid"), "cid"), "minhash-rep")
    bands = reps.select("cid", F.explode(F.array(*(
        F.xxhash64(F.lit(i), F.substring("signature", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(BANDS))))
        .alias("bucket"))
    buckets = common.written(bands.groupBy("bucket").agg(F.min("cid").alias("pivot"), F.count(F.lit(1)).alias("n"))
                             .filter("n > 1").drop("n"), "minhash-bucket")
    members = common.written(bands.join(buckets, "bucket"), "minhash-member")
    pairs = members.filter("cid != pivot").select(F.col("cid").alias("x"), F.col("pivot").alias("y")).distinct()
    pairs = common.written(_agreeing(common.written(pairs, "minhash-pair"), reps), "minhash-near")
    sets = common.written(sets_of(rows, common.written(members.select(F.col("cid").alias("row")).distinct(),
                                                       "minhash-wanted"), "text", width), "minhash-set")
    links = common.written(_confirmed(pairs, sets, percent), "minhash-link")
    comp = common.written(components(links, "x", "y"), "minhash-comp")
    more = common.written(_across(members, comp, reps, sets, percent), "minhash-across")
    if not more.isEmpty():
        links = common.written(links.unionAll(more), "minhash-links")
        comp = common.written(components(links, "x", "y"), "minhash-comp")
    # class -> component of classes -> least doc_id
    of_class = (classes.join(comp.withColumnRenamed("id", "cid"), "cid", "left")
                .select("class", F.coalesce("component", "cid").alias("component"), "least"))
    of_class = common.written(of_class, "minhash-of")
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = common.written(of_class.select("class", "component").join(least, "component"), "minhash-named")
    return (sketch.select("row", "doc_id", "n_shingles", "class").join(named, "class", "left")
            .select("row", "doc_id", "n_shingles", "component",
                    F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                  percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked ones: the one with
    the least id (a null id is the greatest), then the first row.
    Texts without words all stay. Columns are unchanged."""
    rows = common.numbered(docs.select(F.struct(*docs.columns).alias("doc")), "minhash-docs")
    found = common.written(_linked(rows.select("row", F.col("doc")[id_col].alias("doc_id"), F.col("doc")[text_col].alias("text")),
                                   width, percent), "minhash-found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    stay = (found.filter("component is null").select("row").unionAll(
        found.filter("component is not null").groupBy("component").agg(first.alias("f")).select("f.row")))
    # a merge join at every size: most documents stay, so the list of rows
    # is no small side
    kept = rows.join(common.written(stay, "minhash-stay").hint("merge"), "row", "left_semi")
    return kept.select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def _across(members: DataFrame, comp: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes that share a bucket but no component yet.

    Buckets whose largest component is the same one form a cluster; its
    members outside that component meet all its members, both dealt to
    blocks of about ``BLOCK`` classes, one task row per pair of blocks.
    """
    held = common.written(
        members.select("bucket", "cid").join(comp.withColumnRenamed("id", "cid"), "cid", "left")
        .select("bucket", "cid", F.coalesce("component", "cid").alias("component")), "minhash-held")
    sizes = held.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    split = common.written(
        sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("main"))
        .filter("parts > 1").select("bucket", F.col("main.component").alias("main")), "minhash-split")
    open_ = common.written(held.join(split, "bucket").select("main", "cid", "component").distinct(), "minhash-open")
    light = F.col("component") != F.col("main")
    count = common.written(
        open_.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"),
                                  F.ceil(F.sum(light.cast("int")) / BLOCK).alias("light_blocks")), "minhash-count")
    full = common.written(
        open_.join(count, "main").join(reps, "cid").join(sets.withColumnRenamed("row", "cid"), "cid"), "minhash-full")
    member = F.collect_list(F.struct("cid", "component", "signature", "set"))
    place = F.xxhash64("cid")
    blocks = full.groupBy("main", F.pmod(place, "blocks").alias("block")).agg(member.alias("ys"))
    lights = (full.filter(light).groupBy("main", F.pmod(place, "light_blocks").alias("part"))
              .agg(member.alias("xs"), F.first("blocks").alias("blocks"))
              .select("main", "xs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")))

    def run(batches):
        for b in released(batches):
            found = [(int(x), int(y)) for main, xs, ys in zip(*b.columns, strict=True)
                     for x, y in _block_links(main.as_py(), xs, ys, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                              pa.array([p[1] for p in found], pa.int64())], names=["x", "y"])

    return lights.join(blocks, ["main", "block"]).select("main", "xs", "ys").mapInArrow(run, "x long, y long")


def _block_links(main: int, xs, ys, percent: int):
    """Links between two blocks that join components not yet joined here."""
    def columns(block):
        v = block.values
        cid, component = (np.asarray(v.field(i)) for i in (0, 1))
        sig = np.frombuffer(b"".join(v.field(2).to_pylist()), np.uint32).reshape(-1, PERMS)
        return cid, component, sig, [np.frombuffer(s, np.uint64) for s in v.field(3).to_pylist()]

    (cx, px, gx, sx), (cy, py, gy, sy) = columns(xs), columns(ys)
    parent: dict = {}

    def root(c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    nx, ny = np.array([len(s) for s in sx]), np.array([len(s) for s in sy])
    for i in range(len(cx)):
        near = (gy == gx[i]).mean(axis=1) >= SIGNATURE_LEAST
        near &= (py != px[i]) & ((py == main) | (cx[i] > cy))
        near &= 100 * np.minimum(nx[i], ny) >= percent * np.maximum(nx[i], ny)
        for j in np.flatnonzero(near).tolist():
            a, b = root(int(px[i])), root(int(py[j]))
            if a != b and _share(sx[i], sy[j], percent):
                parent[max(a, b)] = min(a, b)
                yield cx[i], cy[j]


def _share(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Sorted distinct sets share at least ``percent`` % of their union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)
