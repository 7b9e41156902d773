"""Hierarchical multi-length packing of documents into token sequences.

Each task packs the documents it reads, a group of about ``GROUP_IDS``
ids at a time, so nothing is shuffled and a lost task is redone alone:

1. a document's full windows of the longest tier become sequences of
   their own; its remainder is routed to the shortest tier that holds it;
2. each tier, longest first, packs its remainders, one per window;
3. the gap of a window is filled from shorter tiers, the longest
   remainder that fits first; when none fits, a remainder is cut to fill
   the gap exactly and the rest returns to its tier;
4. what cannot fill a window of the shortest tier waits for the task's
   next group; the last of it is the task's only padded sequence;
5. the group's sequences are dealt to step groups of about equal numbers
   of tokens, and within that of attention cost (sum of squared lengths).

Tiers are powers of two, so every sequence but a task's last one is
exactly as long as its tier.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import END_ID, encoder, small_batches, tokenizer_path, with_end

TIERS = (2048, 1024, 512, 256)
GROUP_IDS = 1 << 21
STEP_IDS = 1 << 16          # ids of a step group

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, window int, step_id long")


def plan_group(pieces: list[tuple[int, int, int]], tiers: tuple[int, ...], last: bool):
    """Plan the sequences of one group.

    ``pieces``: (length, document, start) with 0 < length. Returns
    (sequences, rest): each sequence is (window, pieces in order), and
    ``rest`` the pieces that wait for the next group (none if ``last``).
    """
    longest = tiers[0]
    out, pool = [], []
    for n, doc, start in pieces:
        while n >= longest:
            out.append((longest, [(longest, doc, start)]))
            n, start = n - longest, start + longest
        if n:
            pool.append((n, doc, start))
    pool.sort()
    for k, window in enumerate(tiers):
        low = tiers[k + 1] if k + 1 < len(tiers) else 0
        while pool and pool[-1][0] > low:
            chosen, gap, put = [], window, []
            if pool[-1][0] > window:        # left over from a longer tier
                n, doc, start = pool.pop()
                out.append((window, [(window, doc, start)]))
                insort(pool, (n - window, doc, start + window))
            elif sum_at_least(pool, window):
                chosen.append(pool.pop())
                gap -= chosen[0][0]
                while gap:
                    i = bisect_right(pool, gap, key=lambda p: p[0])
                    if i:
                        chosen.append(pool.pop(i - 1))
                    else:
                        n, doc, start = pool.pop(0)
                        chosen.append((gap, doc, start))
                        put.append((n - gap, doc, start + gap))
                    gap -= chosen[-1][0]
                for p in put:
                    insort(pool, p)
                out.append((window, chosen))
            else:
                break           # too little is left for this window: a shorter one may do
    if not last:
        return out, pool
    if pool:
        out.append((longest, pool))
    return out, []


def sum_at_least(pool, n: int) -> bool:
    total = 0
    for p in reversed(pool):
        total += p[0]
        if total >= n:
            return True
    return False


def deal_steps(sequences, step_ids: int) -> list[int]:
    """Step group of each sequence: the one with the fewest tokens so far,
    then the least attention cost."""
    total = sum(w for w, _ in sequences)
    heap = [(0, 0, k) for k in range(max(1, -(-total // step_ids)))]
    cost = [sum(n * n for n, _, _ in pieces) for _, pieces in sequences]
    step = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-sequences[i][0], -cost[i])):
        ids, c, k = heap[0]
        heapq.heapreplace(heap, (ids + sequences[i][0], c + cost[i], k))
        step[i] = k
    return step


class _Packer:
    def __init__(self, part: int, tiers, step_ids: int):
        self.tiers, self.step_ids = tiers, step_ids
        self.doc_id, self.ids, self.n = [], [], []      # documents of the group
        self.held = 0
        self.seq = self.step = part << 33

    def add(self, doc_ids: list, ids: np.ndarray, n: np.ndarray):
        ends = np.cumsum(n)
        self.doc_id += doc_ids
        self.ids += [ids[e - k:e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
        self.n += [(k, 0, k) for k in n.tolist()]       # (ids here, ids before them, of the document)
        self.held += len(ids)

    def pack(self, last: bool) -> pa.RecordBatch:
        pieces = [(k, i, before) for i, (k, before, _) in enumerate(self.n)]
        seqs, rest = plan_group(pieces, self.tiers, last)
        steps = deal_steps(seqs, self.step_ids)
        cols = [[] for _ in range(9)]
        for s, ((window, chosen), step) in enumerate(zip(seqs, steps, strict=True)):
            at = 0
            for n, i, start in chosen:
                a = start - self.n[i][1]
                row = (self.doc_id[i], start, n, self.ids[i][a:a + n].astype("<u4").tobytes(), self.n[i][2],
                       self.seq + s, at, window, self.step + step)
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
                at += n
        self.seq += len(seqs)
        self.step += max(steps, default=-1) + 1
        keep = [(self.doc_id[i], self.ids[i][start - self.n[i][1]:][:n].copy(), (n, start, self.n[i][2]))
                for n, i, start in rest]
        self.doc_id, self.ids, self.n = ([k[j] for k in keep] for j in range(3))
        self.held = sum(len(x) for x in self.ids)
        types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
            names=[f.split()[0] for f in SCHEMA.split(", ")])


def pack(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = END_ID, tiers: tuple[int, ...] = TIERS, group_ids: int = GROUP_IDS,
         step_ids: int = STEP_IDS) -> DataFrame:
    """Pack every document's ids (``end_id`` last) into sequences.

    One row per piece: ``doc_id, start`` (ids of the document before the
    piece), ``length, ids`` (little-endian u32 bytes), ``doc_tokens,
    sequence_id, offset`` (in the sequence), ``window`` (the tier),
    ``step_id``. ``tiers`` are descending powers of two.

    Null or empty text: the end id alone. Null doc_id: kept as null.
    Repeated rows are documents of their own; an empty table has no rows;
    other columns of ``docs`` are not read. ``docs`` should come from
    files (a table, a checkpoint), so that a redone task reads the same
    rows. Memory: one group's ids plus one text.
    """
    tok = tokenizer or tokenizer_path()
    if sorted(tiers, reverse=True) != list(tiers) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be descending powers of two")

    def run(batches):
        enc = encoder(tok)
        p = _Packer(TaskContext.get().partitionId(), tiers, step_ids)
        for b in small_batches(batches):
            p.add(b.column(0).to_pylist(), *with_end(*enc.encode(b.column(1)), end_id))
            if p.held >= group_ids:
                yield p.pack(False)
        if p.held:
            yield p.pack(True)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))
