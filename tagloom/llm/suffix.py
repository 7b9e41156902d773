"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if some ``WINDOW``-byte string over it also starts elsewhere in
the corpus (same document or not, overlaps count). Suffix arrays of the
whole corpus would have to be merged all with all, so a content-defined
filter first finds the few places where that matters:

1. Each window has an anchor: its ``GRAM``-byte substring with the least
   hash. Consecutive windows with one anchor are a run. Equal windows have
   equal anchors, so a run whose anchor occurs once in the corpus is
   unique, and runs with equal strings repeat as a whole. Both are counts
   (map-side aggregates); no string is shuffled for them.
2. The distinct strings of all other runs (an anchor shared, the strings
   not: mostly the edges of repeated passages) are dealt to shards by
   anchor. Each shard builds a suffix array by Larsson-Sadakane refinement
   in numpy (ranks of 8 bytes, then doubled, sorting only groups that are
   not single yet), and Kasai common prefixes of its neighbours confirm
   windows that repeat, byte by byte.
3. An anchor with more than ``HOT`` distinct strings is dealt over several
   shards. Those shards export their distinct windows as sorted arrays of
   fingerprints, cut into ranges; a range merges the arrays of all shards
   by binary search and returns what several of them hold.

Window starts are bytes of UTF-8. Runs belong to one document each, so no
match crosses documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.tokens import released
from tagloom.llm.words import mix

WINDOW = 400
GRAM = 32                       # bytes of an anchor
SHARD_BYTES = 3 << 20
HOT = 2048                      # distinct strings of an anchor that one shard takes
RANGE_BYTES = 32 << 20           # fingerprints of all hot shards that a range takes, about
CHUNK = 1 << 20                 # window starts handled at a time
_P = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` (a power of two) bytes, mixed."""
    h = data.astype(np.uint64) + np.uint64(1)
    k, p = 1, _P
    while k < width:
        h = h[:-k] * np.uint64(p) + h[k:]
        p = p * p % (1 << 64)
        k *= 2
    return mix(h)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Index of the (first) least value of every ``width`` values."""
    at, k = np.arange(len(v), dtype=np.int32), 1
    while k * 2 <= width:
        right = v[k:] < v[:-k]
        at = np.where(right, at[k:], at[:-k])
        v = np.where(right, v[k:], v[:-k])
        k *= 2
    if width > k:
        r = width - k
        at = np.where(v[r:] < v[:-r], at[r:], at[:-r])
    return at


def runs_of(texts: list[bytes], window: int = WINDOW):
    """(text number, first window, windows, anchor hash, string hash) arrays
    of the runs of several texts."""
    out = []
    for first, part, at in _pieces(texts, window):
        data = np.frombuffer(part, np.uint8)
        if len(data) < window:
            continue
        h = _gram_hashes(data, GRAM)
        anchor = _least(h, window - GRAM + 1)
        # windows that begin and end in one text
        owner = np.searchsorted(at, np.arange(len(anchor)), side="right") - 1
        ends = np.r_[at[1:], len(data)]
        ok = np.arange(len(anchor)) + window <= ends[owner]
        cut = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (ok[1:] != ok[:-1])]
        begin = np.flatnonzero(cut)
        n = np.diff(np.r_[begin, len(anchor)])
        keep = ok[begin]
        begin, n = begin[keep], n[keep]
        text = owner[begin]
        strings = np.fromiter((xxhash.xxh3_64_intdigest(part[a:b]) for a, b in
                               zip(begin.tolist(), (begin + n + window - 1).tolist(), strict=True)),
                              np.uint64, len(begin))
        out.append((first[0] + text, begin - at[text] + np.where(text == 0, first[1], 0), n,
                    h[anchor[begin]], strings))
    if not out:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _pieces(texts: list[bytes], window: int):
    """Texts joined to pieces of about ``CHUNK`` bytes; a longer text is cut
    into pieces that overlap by ``window - 1`` bytes. Yields ((number of the
    first text, offset in it), bytes, offset of each text)."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:
            for a in range(0, len(texts[i]) - window + 1, CHUNK):
                yield (i, a), texts[i][a:a + CHUNK + window - 1], np.zeros(1, np.int64)
            i += 1
            continue
        j, total, at = i, 0, []
        while j < len(texts) and len(texts[j]) <= CHUNK and (j == i or total + len(texts[j]) <= CHUNK):
            at.append(total)
            total += len(texts[j])
            j += 1
        yield (i, 0), b"".join(texts[i:j]), np.array(at, np.int64)
        i = j


# --- suffix array of a shard ----------------------------------------------------

def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` bytes (a power of two of
    at least 8); equal ranks mean equal bytes. Larsson-Sadakane refinement:
    a round doubles the depth and sorts only suffixes in groups of several."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:n + k]
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).astype(np.int32)
    size = np.diff(np.r_[first, n])
    rank = np.empty(n + depth, np.int32)
    rank[n:] = -1
    rank[order] = np.repeat(first, size)
    active = order[np.repeat(size > 1, size)]       # in rank order
    h = 8
    while h < depth and len(active):
        pair = (rank[active].astype(np.int64) << 32) | (rank[active + h].astype(np.int64) + 1)
        by = np.argsort(pair, kind="stable")
        active, pair = active[by], pair[by]
        group = pair >> 32
        new = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        size = np.diff(np.r_[new, len(pair)])
        # a group keeps the rank of its first place; its parts follow by position
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        inside = new - np.repeat(start, np.diff(np.r_[np.searchsorted(new, start), len(new)]))
        rank[active] = np.repeat((group[new] + inside).astype(np.int32), size)
        active = active[np.repeat(size > 1, size)]
        h *= 2
    return rank[:n]


def kasai(data: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix length, up to ``limit``, of the suffixes at ``a`` and
    ``b``, pair by pair, ``a`` ascending. As in Kasai's algorithm a pair
    that is the pair before it moved on by one byte loses one byte of
    prefix; only the others compare bytes, eight at a time."""
    padded = np.concatenate([data, np.zeros(limit + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    follows = np.zeros(len(a), bool)
    follows[1:] = (a[1:] == a[:-1] + 1) & (b[1:] == b[:-1] + 1)
    out = np.zeros(len(a), np.int64)

    def grow(at, have):
        while len(at):
            same = words[a[at] + have] == words[b[at] + have]
            more = np.where(same.all(axis=1), 8, same.argmin(axis=1))
            have = np.minimum(have + more, limit)
            go = (more == 8) & (have < limit)
            out[at[~go]] = have[~go]
            at, have = at[go], have[go]

    heads = np.flatnonzero(~follows)
    grow(heads, np.zeros(len(heads), np.int64))
    # a chain's pairs inherit the head's prefix less their distance; where the
    # head was cut at the limit, or nothing is left of it, bytes are compared
    chain = np.cumsum(~follows) - 1
    rest = np.flatnonzero(follows)
    if len(rest):
        base = out[heads[chain[rest]]]
        have = np.maximum(base - (rest - heads[chain[rest]]), 0)
        open_ = (base == limit) | (have == 0)
        out[rest[~open_]] = have[~open_]
        grow(rest[open_], have[open_])
    return out


def repeated_windows(strings: list[bytes], several: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """Per string of distinct runs: which of its windows occur again, in
    this shard or (``several``: the string itself occurs again) outside."""
    lens = np.array([len(s) for s in strings], np.int64)
    at = np.cumsum(lens) - lens
    data = np.frombuffer(b"".join(strings), np.uint8)
    half = 1 << (window - 1).bit_length() - 1       # 256 of 400
    rank = suffix_ranks(data, half) if half >= 8 else None
    n = lens - window + 1
    starts = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
    owner = np.repeat(np.arange(len(strings)), n)
    pair = (rank[starts].astype(np.int64) << 32) | rank[starts + window - half]
    by = np.argsort(pair, kind="stable")
    sa = starts[by]                                 # window starts in suffix order
    candidate = np.flatnonzero(pair[by][1:] == pair[by][:-1])
    left, right = sa[candidate], sa[candidate + 1]
    order = np.argsort(left)
    ok = np.zeros(len(candidate), bool)
    ok[order] = kasai(data, left[order], right[order], window) >= window
    hit = np.zeros(len(data) + 1, bool)
    hit[left[ok]] = hit[right[ok]] = True
    res = hit[starts] | several[owner]
    cuts = np.cumsum(n)[:-1]
    return np.split(res, cuts)


def intervals(mask: np.ndarray) -> list[tuple[int, int]]:
    """[first, last] of every run of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


def window_prints(string: bytes, window: int = WINDOW) -> np.ndarray:
    """64-bit fingerprint of every window of a string."""
    data = np.frombuffer(string, np.uint8).astype(np.uint64) + np.uint64(1)
    total, k, p, done = None, 1, _P, 0
    h = data
    # windows of any width from the powers of two in it
    rest = window
    while rest:
        if rest & 1:
            part = h[done:]
            total = part if total is None else total[:len(part)] * np.uint64(p) + part[:len(total)]
            done += k
        rest >>= 1
        if rest:
            h = h[:-k] * np.uint64(p) + h[k:]
            p = p * p % (1 << 64)
            k *= 2
    return mix(total[:len(string) - window + 1])


# --- Spark -------------------------------------------------------------------------

RUN_SCHEMA = "row long, first long, n int, anchor long, string long"
SPAN_SCHEMA = "row long, begin long, last long"


def _runs(window: int):
    def run(batches):
        for b in released(batches):
            rows = np.asarray(b.column(0))
            text, first, n, anchor, string = runs_of(b.column(1).to_pylist(), window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[text]), pa.array(first.astype(np.int64)), pa.array(n.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(string.view(np.int64))],
                names=["row", "first", "n", "anchor", "string"])
    return run


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, str]:
    """(window intervals ``row, begin, last``, ``row, bytes`` of the
    documents that have any, the table that holds these): windows that
    begin at ``begin`` to ``last`` all occur elsewhere too. ``rows`` are
    stored ``row, bytes``."""
    runs = common.written(rows.mapInArrow(_runs(window), RUN_SCHEMA), "suffix-runs")
    anchors = common.written(
        runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("string").alias("lo"), F.max("string").alias("hi"))
        .filter("c > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")), "suffix-anchors")
    shared = common.written(runs.join(anchors, "anchor"), "suffix-shared")
    strings = common.written(
        shared.filter("mixed").groupBy("anchor", "string")
        .agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("row", "first", "n")).alias("at")), "suffix-strings")
    whole = (shared.filter("not mixed").select("row", "first", "n")
             .unionAll(shared.filter("mixed").join(strings.filter("c > 1").select("anchor", "string"), ["anchor", "string"])
                       .select("row", "first", "n"))
             .select("row", F.col("first").alias("begin"), (F.col("first") + F.col("n") - 1).alias("last")))
    whole = common.written(whole, "suffix-whole")
    sizes = common.written(strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("strings"),
                                                         F.sum(F.col("at.n") + window - 1).alias("size"))
                           .withColumn("hot", F.col("strings") > HOT), "suffix-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    wanted = (strings.join(sizes.select("anchor", "hot"), "anchor")
              .select("at.row", F.struct(F.col("at.first"), F.col("at.n"), "anchor", (F.col("c") > 1).alias("several"),
                                         "hot").alias("w"))
              .groupBy("row").agg(F.collect_list("w").alias("wanted")))
    # every document with a span or a string to look at, with its text, once
    touched = (whole.select("row").distinct().join(wanted, "row", "full"))
    texts, table = _bucketed(rows.join(common.written(touched, "suffix-touched"), "row"), "row")
    cut = texts.filter("wanted is not null").select("row", "bytes", "wanted").mapInArrow(
        _cut(window), "row long, first long, n int, anchor long, several boolean, hot boolean, data binary")
    home = F.when(F.col("hot"), F.xxhash64("row", "first")).otherwise(F.xxhash64("anchor"))
    cut = common.written(cut.withColumn("shard", F.pmod(home, F.lit(shards))), "suffix-cut")
    inside = cut.groupBy("shard").applyInArrow(_in_shard(window), SPAN_SCHEMA)
    spans = whole.unionAll(common.written(inside, "suffix-inside"))
    hot = cut.filter("hot")
    if not hot.isEmpty():
        starts = hot.agg(F.sum("n")).first()[0]
        spans = spans.unionAll(common.written(_across(hot, ranges_of(starts), window), "suffix-across"))
    return spans, texts.select("row", "bytes"), table


def _bucketed(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """Write ``df`` bucketed by ``key`` into the warehouse, so that later
    joins on ``key`` do not shuffle it again; the table and its name."""
    import uuid
    spark = df.sparkSession
    n = common.shuffle_partitions(spark)
    name = f"suffix_texts_{uuid.uuid4().hex[:12]}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet").saveAsTable(name)
    return spark.table(name), name


def _cut(window: int):
    def run(batches):
        for b in released(batches):
            out = [[] for _ in range(7)]
            for row, data, wanted in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                data = data.as_buffer().to_pybytes()
                for w in wanted:
                    for c, v in zip(out, (row, w["first"], w["n"], w["anchor"], w["several"], w["hot"],
                                          data[w["first"]:w["first"] + w["n"] + window - 1]), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(),
                                                      pa.bool_(), pa.binary()), strict=True)],
                names=["row", "first", "n", "anchor", "several", "hot", "data"])
    return run


def _span_table(found) -> pa.Table:
    return pa.table({c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate(("row", "begin", "last"))})


def _in_shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        several = np.asarray(table["several"])
        masks = repeated_windows(table["data"].to_pylist(), several, window)
        return _span_table([(row, first + a, first + b)
                            for row, first, s, m in zip(table["row"].to_pylist(), table["first"].to_pylist(),
                                                        several.tolist(), masks, strict=True) if not s
                            for a, b in intervals(m)])
    return run


def ranges_of(windows: int) -> int:
    """Ranges of fingerprints, so that one holds about ``RANGE_BYTES`` of
    those of all shards; at least 64, which small inputs spread over."""
    return max(64, -(-8 * int(windows) // RANGE_BYTES))


def range_edges(prints: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal parts of the 64-bit numbers begins in
    sorted ``prints``, and their end."""
    at = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    return np.r_[0, np.searchsorted(prints, at), len(prints)]


def _across(hot: DataFrame, ranges: int, window: int) -> DataFrame:
    """Windows of hot anchors that several shards hold."""
    def export(table: pa.Table) -> pa.Table:
        prints = np.unique(np.concatenate([window_prints(s, window) for s in table["data"].to_pylist()]))
        edges = range_edges(prints, ranges)
        part = np.flatnonzero(edges[1:] > edges[:-1])      # ranges this shard has any in
        return pa.table({"part": pa.array(part, pa.int32()),
                         "shard": pa.array([table["shard"][0].as_py()] * len(part), pa.int64()),
                         "prints": pa.array([prints[edges[i]:edges[i + 1]].tobytes() for i in part.tolist()], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(p, np.uint64) for p in table["prints"].to_pylist()]
        merged = np.sort(np.concatenate(arrays))
        back = []
        for a in arrays:
            held = np.searchsorted(merged, a, side="right") - np.searchsorted(merged, a, side="left")
            back.append(a[held > 1].tobytes())
        return pa.table({"shard": table["shard"], "prints": pa.array(back, pa.binary())})

    def mark(table: pa.Table, prints: pa.Table) -> pa.Table:
        held = np.sort(np.frombuffer(b"".join(prints["prints"].to_pylist()), np.uint64))
        found = []
        if len(held):
            for row, first, several, data in zip(*(table[c].to_pylist() for c in ("row", "first", "several", "data")),
                                                 strict=True):
                if not several:
                    p = window_prints(data, window)
                    at = np.minimum(np.searchsorted(held, p), len(held) - 1)
                    found += [(row, first + a, first + b) for a, b in intervals(held[at] == p)]
        return _span_table(found)

    exported = hot.groupBy("shard").applyInArrow(export, "part int, shard long, prints binary")
    merged = common.written(exported.groupBy("part").applyInArrow(merge, "shard long, prints binary"), "suffix-merged")
    return hot.groupBy("shard").cogroup(merged.groupBy("shard")).applyInArrow(mark, SPAN_SCHEMA)


REMOVED_SCHEMA = "row long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>"


def removed(spans: DataFrame, texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row, n_removed, n_spans, kept`` (the remaining bytes) and ``spans``
    (removed byte ranges, end exclusive) of documents that lose bytes."""
    per_row = common.written(spans.groupBy("row").agg(F.collect_list(F.struct("begin", "last")).alias("w")), "suffix-spans")

    def run(batches):
        for b in released(batches):
            out = [[] for _ in range(5)]
            for row, data, w in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                data = data.as_buffer().to_pybytes()
                begin, end = (np.asarray(w.values.field(i)) for i in (0, 1))
                by = np.argsort(begin)
                begin, end = begin[by], np.maximum.accumulate(end[by] + window)
                new = np.r_[True, begin[1:] > end[:-1]]
                starts, ends = begin[new], end[np.r_[new[1:], True]]
                kept = [data[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(data)], strict=True)]
                for c, v in zip(out, (row, int((ends - starts).sum()), len(starts), b"".join(kept),
                                      [{"start": s, "end": e} for s, e in
                                       zip(starts.tolist(), ends.tolist(), strict=True)]), strict=True):
                    c.append(v)
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), spans_type),
                                                strict=True)],
                names=["row", "n_removed", "n_spans", "kept", "spans"])

    return texts.join(per_row, "row").select("row", "bytes", "w").mapInArrow(run, REMOVED_SCHEMA)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null texts are empty; texts shorter than ``window`` bytes lose nothing.
    Repeated rows are documents of their own, so each loses what it shares
    with the others. Null ids are kept. An empty table has no rows. Rows are
    told apart by a number that is stored with them once.
    """
    rows = common.numbered(docs.select(F.col(id_col).alias("doc_id"),
                                       F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("bytes")),
                           "suffix-rows")
    spans, texts, table = repeated_spans(rows.select("row", "bytes"), window)
    lost = common.written(removed(spans, texts, window).select(
        "row", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")), "suffix-lost")
    docs.sparkSession.sql(f"DROP TABLE {table}")
    base = common.written(rows.select("row", "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"),
                                      F.sha2("bytes", 256).alias("whole_sha256")), "suffix-base")
    return base.join(lost, "row", "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
