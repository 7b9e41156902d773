"""Token-id files coded by an adaptive context-mixing range coder.

A block holds up to ``BLOCK`` ids of consecutive documents. Its ids are
laid out as strips (up to ``STRIPS``, fewer in a short block) that are
coded side by side, one numpy step per strip position, by 64-bit range
coders (one per strip). All strips of
a block share one model, which every step updates:

* order 2 and order 1 each predict one id (the one seen last in that
  context) with a confidence of 0 to 3;
* the two confidences and whether both agree select a mixing context,
  whose adaptive event counts weigh the order-2 prediction, the order-1
  prediction and the order-0 distribution;
* order 0 is the distribution of the block's ids so far, refreshed at
  fixed steps.

The three weighted parts share one 24-bit interval per id, which drives
the range coder. Every block starts from an empty model and carries a
crc32 of its ids, so blocks decode alone, in any order, and damage shows.

Block layout (little-endian): magic ``TLI1``; u32 vocabulary size, ids,
documents, strips, steps, crc32 of the ids as u32; u64 ids before the block and
documents before it in its file; per document i64 doc_id, u32 ids in this
block, u8 flags (1 null doc_id, 2 begins here, 4 ends here); per strip
u16 words; the strips' 32-bit words.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.common import crc32_concat
from tagloom.llm.tokens import END_ID, encoder, released, small_batches, tokenizer_path, with_end

STRIPS, STEPS = 4096, 128
BLOCK = STRIPS * STEPS
MAX_UNITS = 1_200_000            # cached word parts of a worker (about 40 MB)
GROUP = 1                        # blocks coded side by side (the tables of more leave the cache)
_REFRESH = frozenset((1, 4, 16, 48, 88))
_BITS = 24
_TOTAL = 1 << _BITS
_FINE = 10                       # bits of the 24 that a coarse search leaves open
_LEAST = 16                      # least order-0 frequency of an id
_SLOTS = 1 << 16                 # order-2 contexts of a block
_CTX = 32
_LOW32 = np.uint64(0xFFFFFFFF)
_WORD = np.uint64(32)
_HEAD = struct.Struct("<4s6I2Q")
NULL_ID, BEGINS, ENDS = 1, 2, 4


class _Model:
    """Shared model of ``g`` independent blocks, ``strips`` lanes each."""

    def __init__(self, g: int, strips: int, vocab: int):
        self.g, self.vocab = g, vocab
        block = np.repeat(np.arange(g, dtype=np.int64), strips)
        self.base1, self.base2, self.base_ctx = block * vocab, block * _SLOTS, block * _CTX
        self.base0, self.shift0 = block * (vocab + 1), block << (_BITS + 1)
        self.base_coarse = block * ((_TOTAL >> _FINE) + 1)
        self.t1, self.t2 = np.zeros(g * vocab, np.int32), np.zeros(g * _SLOTS, np.int32)
        self.events = np.tile(np.array([2.0, 2.0, 4.0]), (g * _CTX, 1))
        self.counts = np.zeros(g * vocab, np.int64)
        self.step, self.pending, self.at = 0, [], None
        self._order0()
        self._weights()

    def _order0(self) -> None:
        """Cumulative order-0 frequencies of each block, offset per block
        so that one sorted array serves all of them."""
        if self.pending:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=len(self.counts))
            self.pending = []
        free = _TOTAL - _LEAST * self.vocab
        per = self.counts.reshape(self.g, self.vocab)
        scale = (free / (per.sum(1, keepdims=True) + 0.02 * self.vocab)).astype(np.float32)
        freq = per.astype(np.float32)
        freq += np.float32(0.02)
        freq *= scale * np.float32(0.9999)      # rounding never exceeds the total
        cum = np.zeros((self.g, self.vocab + 1), np.int32)
        np.cumsum(freq.astype(np.int32) + _LEAST, axis=1, out=cum[:, 1:])
        cum[:, -1] = _TOTAL
        cum += (np.arange(self.g, dtype=np.int32) << (_BITS + 1))[:, None]
        self.cum = cum.ravel()                  # GROUP << 25 must stay below 2^31
        # places in ``cum`` of every 2^_FINE-th point: where a search starts
        edges = np.arange((_TOTAL >> _FINE) + 1, dtype=np.int32) << _FINE
        every = (np.arange(self.g, dtype=np.int32) << (_BITS + 1))[:, None] + edges
        self.coarse = np.searchsorted(self.cum, every.ravel(), side="right") - 1

    def _weights(self) -> None:
        part = self.events[:, :2] / self.events.sum(1, keepdims=True)
        w = np.maximum((part * (_TOTAL * 0.875)).astype(np.int64), 64)
        self.w2, self.w1 = w[:, 0].copy(), w[:, 1].copy()
        self.w1[1::2] = 0           # both predict the same id

    def predict(self, prev1, prev2):
        self.i1 = self.base1 + prev1 if self.at is None else self.at
        self.i2 = self.base2 + ((prev1 * 40503 + prev2 * 30011) & (_SLOTS - 1))
        self.e1, self.e2 = self.t1.take(self.i1), self.t2.take(self.i2)
        self.p1, self.p2 = self.e1 >> 2, self.e2 >> 2
        self.same = self.p1 == self.p2
        self.ctx = self.base_ctx + (((self.e2 & 3) << 3) | ((self.e1 & 3) << 1)) + self.same
        self.m2, self.m1 = self.w2.take(self.ctx), self.w1.take(self.ctx)
        self.rest = _TOTAL - self.m2 - self.m1

    def interval(self, x, hit2, hit1):
        """[start, end) of ids ``x`` in the 24-bit interval of each lane."""
        at = self.base0 + x
        lo, hi = self.cum.take(at) - self.shift0, self.cum.take(at + 1) - self.shift0
        lo *= self.rest
        hi *= self.rest
        lo >>= _BITS
        hi >>= _BITS
        head = self.m2 + self.m1
        lo += head
        hi += head
        np.copyto(lo, 0, where=hit2)
        np.copyto(hi, self.m2, where=hit2)
        np.copyto(lo, self.m2, where=hit1)
        np.copyto(hi, head, where=hit1)
        return lo, hi

    def symbol(self, slot):
        """Ids whose interval holds ``slot`` and which prediction hit."""
        hit2 = slot < self.m2
        head = self.m2 + self.m1
        hit1 = ~hit2 & (slot < head)
        x = np.where(hit2, self.p2, self.p1)
        miss = np.flatnonzero(slot >= head)
        u = (((slot[miss] - head[miss] + 1) << _BITS) - 1) // self.rest[miss]
        key = u + self.shift0[miss]
        place = self.base_coarse[miss] + (u >> _FINE)
        lo, hi = self.coarse.take(place), self.coarse.take(place + 1)
        for _ in range(int((hi - lo).max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            below = self.cum.take(mid) <= key
            np.copyto(lo, mid, where=below)
            np.copyto(hi, mid - 1, where=~below & (lo < mid))
        x[miss] = lo - self.base0[miss]
        return x, hit2, hit1

    def update(self, x, hit2, hit1):
        self.at = self.base1 + x
        self.pending.append(self.at)
        event = self.ctx * 3
        event += 2
        event -= hit1
        event -= hit2
        event -= hit2               # 0: order 2 was right, 1: order 1, 2: neither
        seen = np.bincount(event, minlength=self.g * _CTX * 3)
        self.events = self.events * 0.98 + seen.reshape(-1, 3)
        fresh = x << 2
        for table, at, e, p in ((self.t1, self.i1, self.e1, self.p1), (self.t2, self.i2, self.e2, self.p2)):
            table[at] = np.where(p == x, np.minimum(e + 1, fresh + 3), fresh)
        self.step += 1
        self._weights()
        if self.step in _REFRESH:
            self._order0()


def _narrow(low, rng, at):
    """Lanes ``at`` have a range below 2^32: clip it at the next 2^32
    boundary if it crosses one, and shift out the settled upper word."""
    lo, r = low[at], rng[at]
    r = np.where((lo ^ (lo + r)) > _LOW32, (np.uint64(0) - lo) & _LOW32, r)
    low[at] = lo << _WORD
    rng[at] = r << _WORD
    return lo >> _WORD


def shape(n: int) -> tuple[int, int]:
    """(strips, steps) of a block of ``n`` ids: strips are a power of two,
    and a short block has few, so that its model still learns step by step."""
    strips = min(STRIPS, max(16, 1 << ((n - 1) // STEPS).bit_length()))
    return strips, -(-n // strips)


def encode_group(blocks: list[np.ndarray], vocab: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Code blocks of one shape: (steps, words per strip, words)."""
    g = len(blocks)
    strips, steps = shape(max(len(b) for b in blocks))
    x = np.zeros((g, strips * steps), np.int64)
    for row, b in zip(x, blocks, strict=True):
        row[:len(b)] = b
    x = np.ascontiguousarray(x.reshape(g * strips, steps).T)
    lanes = g * strips
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out, n = np.zeros((lanes, steps + 1), np.uint32), np.zeros(lanes, np.int64)
    model = _Model(g, strips, vocab)
    prev1 = prev2 = np.zeros(lanes, np.int64)
    for now in x:
        model.predict(prev1, prev2)
        hit2 = now == model.p2
        hit1 = (now == model.p1) & ~hit2
        lo, hi = model.interval(now, hit2, hit1)
        rng >>= np.uint64(_BITS)
        low += rng * lo.view(np.uint64)
        rng *= (hi - lo).view(np.uint64)
        at = np.flatnonzero(rng <= _LOW32)
        if len(at):
            out[at, n[at]] = _narrow(low, rng, at)
            n[at] += 1
        model.update(now, hit2, hit1)
        prev1, prev2 = now, prev1
    # a range is wider than 2^32 here, so one more word names a point in it
    out[np.arange(lanes), n] = (low + _LOW32) >> _WORD
    n += 1
    res = []
    for b in range(g):
        rows, lens = out[b * strips:(b + 1) * strips], n[b * strips:(b + 1) * strips]
        res.append((steps, lens, rows[np.arange(steps + 1) < lens[:, None]]))
    return res


def decode_group(coded: list[tuple[int, np.ndarray, np.ndarray]], vocab: int) -> list[np.ndarray]:
    """Ids (with the padding of the last strip) of blocks of one shape."""
    g, steps, strips = len(coded), coded[0][0], len(coded[0][1])
    lanes = g * strips
    words = np.concatenate([w for _, _, w in coded] + [np.zeros(1, np.uint32)]).astype(np.uint64)
    lens = np.concatenate([c for _, c, _ in coded]).astype(np.int64)
    end = np.cumsum(lens)
    at = end - lens

    def take(which):
        """The next word of strips; 0 past a strip's end."""
        word = np.where(at[which] < end[which], words[np.minimum(at[which], len(words) - 1)], np.uint64(0))
        at[which] += 1
        return word

    every = np.arange(lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    code = take(every) << _WORD
    code |= take(every)
    model = _Model(g, strips, vocab)
    prev1 = prev2 = np.zeros(lanes, np.int64)
    x = np.zeros((steps, lanes), np.int64)
    for i in range(steps):
        model.predict(prev1, prev2)
        rng >>= np.uint64(_BITS)
        slot = np.minimum((code - low) // rng, np.uint64(_TOTAL - 1)).view(np.int64)
        now, hit2, hit1 = model.symbol(slot)
        lo, hi = model.interval(now, hit2, hit1)
        low += rng * lo.view(np.uint64)
        rng *= (hi - lo).view(np.uint64)
        need = np.flatnonzero(rng <= _LOW32)
        if len(need):
            _narrow(low, rng, need)
            code[need] = (code[need] << _WORD) | take(need)
        model.update(now, hit2, hit1)
        x[i] = now
        prev1, prev2 = now, prev1
    flat = x.T.reshape(g, strips * steps)
    return list(flat)


# --- blocks as bytes -----------------------------------------------------------

@dataclass
class Docs:
    """Documents, or pieces of them, of one block."""
    doc_id: np.ndarray      # int64
    n_ids: np.ndarray       # ids of the document in this block
    flags: np.ndarray       # NULL_ID | BEGINS | ENDS


def pack_block(coded, ids: np.ndarray, docs: Docs, vocab: int, id_start: int, doc_start: int) -> bytes:
    steps, lens, words = coded
    head = _HEAD.pack(b"TLI1", vocab, len(ids), len(docs.doc_id), len(lens), steps,
                      common.crc32_ids(ids), id_start, doc_start)
    return b"".join((head, docs.doc_id.astype("<i8").tobytes(), docs.n_ids.astype("<u4").tobytes(),
                     docs.flags.astype("u1").tobytes(), lens.astype("<u2").tobytes(),
                     words.astype("<u4").tobytes()))


def unpack_block(data: bytes):
    magic, vocab, n, n_docs, strips, steps, crc, id_start, doc_start = _HEAD.unpack_from(data)
    if magic != b"TLI1":
        raise ValueError("not a token-id block")
    at = _HEAD.size

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    docs = Docs(take("<i8", n_docs), take("<u4", n_docs).astype(np.int64), take("u1", n_docs))
    lens = take("<u2", strips).astype(np.int64)
    return vocab, n, crc, id_start, doc_start, docs, (steps, lens, take("<u4", int(lens.sum())))


def decode_blocks(datas: list[bytes]):
    """(index, docs, id_start, doc_start, ids) of each block; blocks of equal
    shape are decoded side by side. Raises ValueError on a bad checksum."""
    heads = [unpack_block(d) for d in datas]
    shapes: dict = {}
    for i, h in enumerate(heads):
        shapes.setdefault((h[0], h[6][0], len(h[6][1])), []).append(i)
    for (vocab, *_), members in shapes.items():
        for k in range(0, len(members), GROUP):
            part = members[k:k + GROUP]
            for i, ids in zip(part, decode_group([heads[j][6] for j in part], vocab), strict=True):
                _, n, crc, id_start, doc_start, docs, _ = heads[i]
                ids = ids[:n].astype("<u4")
                if zlib.crc32(ids.tobytes()) != crc:
                    raise ValueError(f"token-id block at id {id_start}: checksum differs")
                yield i, docs, id_start, doc_start, ids


# --- Spark ----------------------------------------------------------------------

BLOCK_SCHEMA = "file int, block int, n_ids long, payload binary"
PIECE_SCHEMA = ("file int, doc_no long, doc_id long, start long, n_ids long, whole boolean, ids binary")


class _Writer:
    """Cuts the documents of one file into blocks, ``GROUP`` at a time."""

    def __init__(self, vocab: int, part: int):
        self.vocab, self.part = vocab, part
        self.ids, self.docs = [], []          # not yet in a block
        self.held = 0
        self.block = self.id_start = self.doc_start = 0
        self.open = False                     # the first held document began in an earlier block

    def add(self, ids, n, doc_ids, nulls):
        self.ids.append(ids)
        self.docs.append((doc_ids, n, nulls))
        self.held += len(ids)

    def flush(self, last: bool):
        if self.held < BLOCK * GROUP and not last or not self.held:
            return None
        ids = np.concatenate(self.ids)
        doc_id, n, nulls = (np.concatenate([d[i] for d in self.docs]) for i in range(3))
        ends = np.cumsum(n)
        full = len(ids) // BLOCK
        cuts = [(k * BLOCK, (k + 1) * BLOCK) for k in range(full)]
        if last and len(ids) > full * BLOCK:
            cuts.append((full * BLOCK, len(ids)))
        coded = []
        for k in range(0, full, GROUP):
            coded += encode_group([ids[a:b] for a, b in cuts[k:min(k + GROUP, full)]], self.vocab)
        coded += [encode_group([ids[a:b]], self.vocab)[0] for a, b in cuts[full:]]
        rows = []
        begins = ends - n
        for (a, b), c in zip(cuts, coded, strict=True):
            i, j = np.searchsorted(ends, a, side="right"), np.searchsorted(begins, b, side="left")
            first = (begins[i:j] >= a) & ~(self.open & (np.arange(i, j) == 0))
            flags = nulls[i:j] * NULL_ID + first * BEGINS + (ends[i:j] <= b) * ENDS
            docs = Docs(doc_id[i:j], np.minimum(ends[i:j], b) - np.maximum(begins[i:j], a), flags)
            rows.append((self.part, self.block, b - a,
                         pack_block(c, ids[a:b], docs, self.vocab, self.id_start + a, self.doc_start + int(i))))
            self.block += 1
        used = cuts[-1][1]
        keep = int(np.searchsorted(ends, used, side="right"))
        self.id_start += used
        self.doc_start += keep
        if keep < len(n):
            left = n[keep:].copy()
            self.open = bool(begins[keep] < used) or (keep == 0 and self.open)
            left[0] = ends[keep] - max(begins[keep], used)
            self.docs = [(doc_id[keep:], left, nulls[keep:])]
        else:
            self.docs, self.open = [], False
        self.ids, self.held = [ids[used:]], len(ids) - used
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                                            (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
            names=["file", "block", "n_ids", "payload"])


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id",
              text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text and write the ids as coded blocks to ``path``.

    Documents are ordered by ``id_col`` (nulls first; rows with equal ids
    by text) over range partitions; each partition becomes one "file" of
    consecutive blocks, so a file can be read alone and files follow each
    other in document order. Null and empty texts have the end id only.
    An empty table writes no blocks. Other columns of ``docs`` are not
    read. Memory: the ids of ``GROUP`` blocks per task, however long a
    text is beyond the text itself.
    """
    tok = tokenizer or tokenizer_path()

    def code(batches):
        part = TaskContext.get().partitionId()
        enc = encoder(tok, MAX_UNITS)
        w = _Writer(len(enc.last), part)
        for b in small_batches(batches):
            ids, n = with_end(*enc.encode(b.column(1)), end_id)
            nulls = np.asarray(b.column(0).is_null())
            w.add(ids, n, np.asarray(b.column(0).fill_null(0)), nulls)
            if (rows := w.flush(False)) is not None:
                yield rows
        if (rows := w.flush(True)) is not None:
            yield rows

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = common.shuffle_partitions(docs.sparkSession)
    (rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(code, BLOCK_SCHEMA).write.parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of documents as stored: ``file, doc_no`` (number of the
    document in its file), ``doc_id, start`` (ids before the piece in its
    file), ``n_ids, whole`` (the piece is the whole document) and ``ids``
    (little-endian u32 bytes). Every block is checked against its crc32."""

    def decode(batches):
        held = []

        def out():
            cols = [[] for _ in range(7)]
            for k, docs, id_start, doc_start, ids in decode_blocks([p for _, p in held]):
                f = held[k][0]
                ends = np.cumsum(docs.n_ids)
                raw = ids.tobytes()
                for i, (d, n, e, fl) in enumerate(zip(docs.doc_id.tolist(), docs.n_ids.tolist(),
                                                      ends.tolist(), docs.flags.tolist(), strict=True)):
                    for c, v in zip(cols, (f, doc_start + i, None if fl & NULL_ID else d, id_start + e - n, n,
                                           fl & (BEGINS | ENDS) == BEGINS | ENDS,
                                           raw[4 * (e - n):4 * e]), strict=True):
                        c.append(v)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), *[pa.int64()] * 4, pa.bool_(), pa.binary()),
                                                strict=True)],
                names=["file", "doc_no", "doc_id", "start", "n_ids", "whole", "ids"])

        for b in released(batches):
            for f, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.append((f, p))
                if len(held) == GROUP:
                    yield out()
                    held = []
        if held:
            yield out()

    return (spark.read.schema(BLOCK_SCHEMA).parquet(path).select("file", "payload")
            .mapInArrow(decode, PIECE_SCHEMA))


def documents_of(pieces: DataFrame) -> DataFrame:
    """One row per document from ``read_ids`` pieces: ``file, doc_no,
    doc_id, start`` (in its file), ``n_ids, ids_crc32``."""
    digest = common.written(pieces.withColumn("crc", F.crc32("ids")).drop("ids"), "id-pieces")
    cut = (digest.filter(~F.col("whole")).groupBy("file", "doc_no")
           .agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"),
                F.sum("n_ids").alias("n_ids"),
                F.sort_array(F.collect_list(F.struct("start", "n_ids", "crc"))).alias("pieces")))

    @F.pandas_udf("long")
    def joined(pieces):
        return pieces.map(lambda ps: reduce(lambda crc, p: crc32_concat(crc, p["crc"], 4 * p["n_ids"]), ps, 0))

    cols = ["file", "doc_no", "doc_id", "start", "n_ids"]
    return (digest.filter("whole").select(*cols, F.col("crc").alias("ids_crc32"))
            .unionAll(cut.select(*cols, joined("pieces").alias("ids_crc32"))))


def file_starts(spark: SparkSession, path: str):
    """Ids in all files before a row's ``file``, as a column (one number
    per file reaches the driver: at most the shuffle partitions)."""
    sizes = dict(spark.read.schema(BLOCK_SCHEMA).parquet(path).groupBy("file")
                 .agg(F.sum("n_ids").alias("n")).collect())
    starts, total = [], 0
    for f in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(f, 0)
    return F.element_at(F.lit(starts or [0]).cast("array<bigint>"), F.col("file") + 1)
