"""Document fingerprints by consistent weighted sampling.

A text's terms are its words and adjacent word pairs, weighted by how
often they occur. For each of ``SAMPLES`` samples every term gets a
gamma(2, 1) step r, a gamma(2, 1) score c and a uniform shift b, all
functions of the term alone; with weight S,

    t = floor(ln S / r + b),  y = exp(r (t - b)),  a = c / (y exp r)

and the term with the least ``a`` is the sample, together with its ``t``.
Two texts have equal samples with probability sum(min) / sum(max) over
their weights, the generalised Jaccard similarity (Ioffe 2010). A
fingerprint keeps 16 bits of each sample; likeness is the share of equal
samples.

The random numbers of a term come from two pools of ``POOL`` rows, one for
(r, b) and one for c, picked by different bits of the term's hash, so two
terms share all of them with probability 1 / POOL^2.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.tokens import small_batches
from tagloom.llm.words import mix, word_hashes

SAMPLES = 64
POOL = 8192
_HASH_BITS = 44             # of a term inside its text (the rest numbers the text)
_CHUNK = 1 << 17            # terms handled at a time


class _Pools:
    def __init__(self):
        rng = np.random.default_rng(20100)
        r = rng.gamma(2.0, 1.0, (SAMPLES, POOL))
        b = rng.random((SAMPLES, POOL))
        self.r, self.b = r.astype(np.float32), b.astype(np.float32)
        self.inv_r = (1 / r).astype(np.float32)
        self.once = (r * (1 - b)).astype(np.float32)        # of a term that occurs once: t = 0
        self.ln_c = np.log(rng.gamma(2.0, 1.0, (SAMPLES, POOL))).astype(np.float32)


_POOLS: list[_Pools] = []


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term hashes, counts, offsets per text), terms distinct per text."""
    h, offs = word_hashes(texts)
    n = np.diff(offs)
    text = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    words = mix(h)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) if len(h) else words
    inner = text[:-1] == text[1:]
    top = np.uint64(64 - _HASH_BITS)
    keys = np.concatenate([(text << np.uint64(_HASH_BITS)) | (words >> top),
                           ((text[:-1] << np.uint64(_HASH_BITS)) | (pairs >> top))[inner]])
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(keys)])
    keys = keys[first]
    starts = np.searchsorted(keys, np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(_HASH_BITS))
    return mix(keys & np.uint64((1 << _HASH_BITS) - 1)), counts, starts


def samples(texts: pa.Array) -> np.ndarray:
    """16-bit samples, one row of ``SAMPLES`` per text (null or without
    words: all 0, which no text with words has)."""
    if not _POOLS:
        _POOLS.append(_Pools())
    pools = _POOLS[0]
    out = np.zeros((len(texts), SAMPLES), np.uint16)
    for lo in range(0, len(texts), 1 << 18):        # texts are numbered in 20 bits
        h, counts, offs = _terms(texts.slice(lo, 1 << 18))
        full = np.flatnonzero(np.diff(offs))
        # whole texts, about _CHUNK terms at a time (a longer text alone)
        at = 0
        while at < len(full):
            end = max(at + 1, int(np.searchsorted(offs[full + 1], offs[full[at]] + _CHUNK, side="right")))
            part = full[at:end]
            a, b = offs[part[0]], offs[part[-1] + 1]
            out[lo + part] = _chunk(pools, h[a:b], counts[a:b], offs[part] - a)
            at = end
    return out


def _chunk(pools: _Pools, h: np.ndarray, counts: np.ndarray, begin: np.ndarray) -> np.ndarray:
    i1 = (h & np.uint64(POOL - 1)).astype(np.int64)
    i2 = ((h >> np.uint64(20)) & np.uint64(POOL - 1)).astype(np.int64)
    lens = np.diff(np.r_[begin, len(h)])
    many = np.flatnonzero(counts > 1)
    ln_s = np.log(counts).astype(np.float32)
    m1, m2, ln_many = i1[many], i2[many], ln_s[many]
    out = np.empty((len(begin), SAMPLES), np.uint16)
    for k in range(SAMPLES):
        ln_a = pools.ln_c[k].take(i2)
        ln_a -= pools.once[k].take(i1)
        if len(many):
            r, b = pools.r[k].take(m1), pools.b[k].take(m1)
            t = np.floor(ln_many * pools.inv_r[k].take(m1) + b)
            ln_a[many] = pools.ln_c[k].take(m2) - r * (t - b + 1)
        least = np.minimum.reduceat(ln_a, begin)
        hits = np.flatnonzero(ln_a == np.repeat(least, lens))
        # the first of equal terms in hash order
        which = hits[np.searchsorted(hits, begin)]
        j = i1[which]
        t = np.floor(ln_s[which] * pools.inv_r[k].take(j) + pools.b[k].take(j)).astype(np.int64)
        code = mix(h[which] + t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
        out[:, k] = (code >> np.uint64(48)) | np.uint64(1)      # never 0
    return out


def as_text(rows: np.ndarray) -> list[str]:
    """Fingerprints as lowercase hex, four digits a sample."""
    return [r.astype(">u2").tobytes().hex() for r in rows]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text in ``out`` (a column
    of that name is replaced). Null, empty and blank texts share the
    fingerprint of no terms. Equal texts have equal fingerprints; no other
    row is needed, so nothing is shuffled."""
    @F.pandas_udf("string")
    def of(text):
        import pandas as pd
        col = pa.Array.from_pandas(text, type=pa.large_string())
        rows = [as_text(samples(b.column(0)))
                for b in small_batches([pa.RecordBatch.from_arrays([col], names=["t"])])]
        return pd.Series([x for r in rows for x in r], dtype=object)

    return docs.withColumn(out, of(F.col(text_col)))


# --- each text against its edited form and the next document --------------------

def beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket, guest, doc_id, text`` laid out so that a task reads runs of
    consecutive documents: ids are cut into ranges, a range is sorted by
    id (null first), then text, and ends with a ``guest`` copy of the
    first document of the next range (the last range: of the first one).

    Range bounds and first ids, one number per shuffle partition each, are
    all that reaches the driver; texts are shuffled once.
    """
    from pyspark.ml.feature import Bucketizer

    low = -(1 << 63)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(low)).alias("key"))
    rows = rows.withColumn("key_d", F.col("key").cast("double"))
    n = common.shuffle_partitions(docs.sparkSession)
    cuts = sorted(set(rows.approxQuantile("key_d", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    if cuts:
        rows = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="key_d",
                          outputCol="bucket").transform(rows).withColumn("bucket", F.col("bucket").cast("int"))
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    firsts = dict(rows.groupBy("bucket").agg(F.min("key")).collect())
    order = sorted(firsts)
    first = [firsts.get(b, 0) for b in range(len(cuts) + 1)]
    before = [order[order.index(b) - 1] if b in firsts else 0 for b in range(len(cuts) + 1)]
    at = F.col("bucket") + 1
    is_first = F.col("key") == F.element_at(F.lit(first).cast("array<bigint>"), at)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(F.element_at(F.lit(before).cast("array<int>"), at).alias("bucket"), F.lit(1).alias("guest"))
    return (rows.withColumn("to", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))))
            .select("to.bucket", "to.guest", "doc_id", "text")
            # range k is partition k: no two ranges meet in one task
            .repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "guest", "doc_id", "text"))


EDIT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, the fingerprint of its edited text
    (the last quarter of its code points replaced by as many from the
    start of the next document) and both likenesses. Null text: empty.
    Rows with equal ids follow each other by text; a single document is
    its own next one; an empty table has no rows. Memory: one batch."""

    def run(batches):
        held = None         # (bucket, guest, doc_id, text, samples) of the last row so far
        for b in small_batches(batches, 8 << 20):
            texts = [t or "" for t in b.column(3).to_pylist()]
            prints = samples(b.column(3))
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts,
                            prints, strict=True))
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            pairs = [(x, y) for x, y in zip(rows[:-1], rows[1:], strict=True) if not x[1] and x[0] == y[0]]
            if not pairs:
                continue
            edited = [x[3][:len(x[3]) - len(x[3]) // 4] + y[3][:len(x[3]) // 4] for x, y in pairs]
            own, after = np.array([x[4] for x, _ in pairs]), np.array([y[4] for _, y in pairs])
            new = samples(pa.array(edited, pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[2] for x, _ in pairs], pa.int64()), pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                 pa.array(as_text(own)), pa.array(as_text(new)), pa.array(likeness(own, new)),
                 pa.array(likeness(own, after))],
                names=[f.split()[0] for f in EDIT_SCHEMA.split(", ")])

    return beside_next(docs, id_col, text_col).mapInArrow(run, EDIT_SCHEMA)
