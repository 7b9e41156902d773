"""Phrase collocations by Toivonen mining.

A sample of the documents, mined with a lowered threshold, proposes the
set S of phrases that may be frequent; its negative border are the phrases
that are not in S but whose first and last ``k - 1`` words are (every word
outside S is of the border). One full pass counts both: phrases of S
exactly, phrases of the border in hash buckets, two bytes an occurrence. A
border phrase in a bucket below the threshold is proved infrequent. The
others are border failures: the expansion pass counts them exactly, with
every phrase that holds one of them and whose other parts are in S or hold
one too. That closes the set. A frequent phrase that the full pass did not
count exactly holds a least part outside S; this part is of the border and
frequent, so its bucket is full; the expansion pass counts what holds it.
The result is exact whatever the sample.

S and the full buckets reach the tasks as bitmaps of hashes of at most
``2 ** MAX_BITS`` bits, whatever the input; phrases that share a bit are
counted needlessly, never wrongly. A phrase's identity is the sequence of
its words' 96-bit hashes, a binary key whose slices are the keys of its
parts, so cuts and containment are plain joins. Counts are added per Arrow
batch, then by Spark with map-side partials: a very common phrase is one
row per batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.tokens import released, small_batches
from tagloom.llm.words import mix
from tagloom.operators.partitioning import spread

LONGEST = 5
LEAST = 100                 # occurrences of a candidate
TOP = 2000
SAMPLE = 0.125              # share of the documents that proposes phrases
BREAK = r"[.,;:!?\x0A-\x0D]"
WORD_BYTES = 12             # of a word's hash in a key
MIN_BITS, MAX_BITS = 20, 28
RANGE_BITS = 16             # buckets or bits that a task gathers at a time
BATCH_BYTES = 8 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)

COUNT_SCHEMA = "lang string, key binary, word string, c long"


def lowered(least: int, share: float) -> int:
    """Threshold in the sample: two standard deviations under the expected
    count of a phrase that is just frequent."""
    want = least * share
    return max(2, int(want - 2 * want ** 0.5))


def _hashes(words: list[str]) -> np.ndarray:
    """96-bit hash of each word, as rows of bytes."""
    raw = b"".join(xxhash.xxh3_128_digest(w)[:WORD_BYTES] for w in words)
    return np.frombuffer(raw, np.uint8).reshape(-1, WORD_BYTES)


def _first_words(keys: np.ndarray) -> np.ndarray:
    """The first 64 bits of each 96-bit hash."""
    return np.ascontiguousarray(keys[:, :8]).view("<u8")[:, 0]


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang))


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(h * _MUL + word)


def _marked(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _words(texts: pa.Array):
    """(vocabulary, word number of every word, text of every word, words up
    to the end of its piece) of a string column (null: empty)."""
    texts = pc.fill_null(pc.ascii_lower(texts).cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, BREAK, " ; "))
    offs = np.asarray(parts.offsets).astype(np.int64)
    enc = parts.values.slice(offs[0], offs[-1] - offs[0]).dictionary_encode()
    idx, offs = np.asarray(enc.indices).astype(np.int64), offs - offs[0]
    vocab = enc.dictionary.to_pylist()
    stop = np.isin(idx, [i for i, w in enumerate(vocab) if w in (";", "")])
    ends = np.zeros(len(idx) + 1, bool)
    ends[:-1] = stop
    ends[offs[1:]] = True                       # a text's end
    borders = np.flatnonzero(ends)
    at = np.flatnonzero(~stop)
    left = borders[np.searchsorted(borders, at, side="right")] - at
    # the first word of a text stands on the border of the text before it
    owner = np.searchsorted(offs, at, side="right") - 1
    return vocab, idx[at], owner, left


class Grams:
    """Words of a batch of texts, and phrases as the places they begin at."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        self.vocab, self.idx, owner, self.left = _words(texts)
        names = langs.dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        self.lang = np.asarray(names.indices).astype(np.int64)[owner]
        self.keys = _hashes(self.vocab)
        self.first = _first_words(self.keys)[self.idx]

    def totals(self) -> pa.RecordBatch:
        """The empty phrase: all words of each language."""
        which, n = np.unique(self.lang, return_counts=True)
        return _batch([self.langs[i] for i in which.tolist()], self.keys[:0], 0, None, n)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of every word."""
        start = np.array([_lang_hash(x) for x in self.langs], np.uint64)
        return np.arange(len(self.idx)), mix(start[self.lang] * _MUL + self.first) if len(self.idx) else self.first

    def longer(self, here: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first part, hash) of the phrases of k words whose
        parts of k - 1 words begin at two of ``here``."""
        pair = np.flatnonzero((here[1:] == here[:-1] + 1) & (self.left[here[:-1]] >= k))
        return pair, _longer(h[pair], self.first[here[pair] + k - 1])

    def counts(self, here: np.ndarray, k: int, ids: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
        """(rows, number of each phrase) of the phrases of k words at
        ``here``; equal ``ids`` are equal phrases."""
        _, at, ids, c = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
        at = here[at]
        rows = self.keys[self.idx[at[:, None] + np.arange(k)]].reshape(len(at), -1)
        words = [self.vocab[i] for i in self.idx[at].tolist()] if k == 1 else None
        return _batch([self.langs[i] for i in self.lang[at].tolist()], rows, k, words, c), ids

    def single(self, here: np.ndarray) -> np.ndarray:
        return self.lang[here] * len(self.vocab) + self.idx[here]


def _pair_ids(ids: np.ndarray, pair: np.ndarray) -> np.ndarray:
    return ids[pair] * (int(ids.max(initial=0)) + 1) + ids[pair + 1]


def proposed(g: Grams, member: np.ndarray | None, low: int, high: int):
    """Counts of the phrases of ``low`` to ``high`` words whose parts of
    ``low - 1`` words are all in ``member``."""
    here, h = g.words()
    ids = g.single(here)
    for k in range(1, high + 1):
        if k > 1:
            pair, new = g.longer(here, h, k)
            ids, here, h = _pair_ids(ids, pair), here[pair], new
        if k < low:
            ok = _marked(member, h)
            here, h, ids = here[ok], h[ok], ids[ok]
        if not len(here):
            return
        rows, ids = g.counts(here, k, ids)
        if k >= low:
            yield rows


def counted(g: Grams, member: np.ndarray, longest: int) -> tuple[list[pa.RecordBatch], np.ndarray]:
    """(counts of the phrases in ``member`` whose parts all are, hashes of
    every occurrence of a border phrase)."""
    out, border = [g.totals()], []
    here, h = g.words()
    ids = g.single(here)
    for k in range(1, longest + 1):
        if k > 1:
            pair, new = g.longer(here, h, k)
            ids, here, h = _pair_ids(ids, pair), here[pair], new
        ok = _marked(member, h)
        border.append(h[~ok])
        here, h, ids = here[ok], h[ok], ids[ok]
        if not len(here):
            break
        rows, ids = g.counts(here, k, ids)
        out.append(rows)
    return out, np.concatenate(border)


def expanded(g: Grams, member: np.ndarray, full: np.ndarray, longest: int):
    """Counts of the border phrases in full buckets, and of the phrases that
    hold one and whose other parts are in ``member`` or hold one."""
    here, h = g.words()
    both = np.ones(len(here), bool)                 # both parts are in member, and theirs
    for k in range(1, longest + 1):
        if k > 1:
            pair, h = g.longer(here, h, k)
            here, both = here[pair], inside[pair] & inside[pair + 1]
        inside = both & _marked(member, h)
        holds = ~both | (~inside & _marked(full, h))
        at = here[holds]
        if len(at):
            places = g.idx[at[:, None] + np.arange(k)]
            _, ids = np.unique(np.column_stack([g.lang[at], places]), axis=0, return_inverse=True)
            yield g.counts(at, k, ids)[0]
        keep = inside | holds
        here, h, inside = here[keep], h[keep], inside[keep]
        if not len(here):
            return


def _batch(langs, rows: np.ndarray, k: int, words, c: np.ndarray) -> pa.RecordBatch:
    n = len(c)
    offs = np.arange(n + 1, dtype=np.int32) * (k * WORD_BYTES)
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    key = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offs.tobytes()), data])
    word = pa.nulls(n, pa.string()) if words is None else pa.array(words, pa.string())
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), key, word, pa.array(c.astype(np.int64))],
                                      names=["lang", "key", "word", "c"])


def _key_hashes(langs: list[str], keys: list[bytes]) -> np.ndarray:
    """Hashes of phrases by their keys, as ``gram_counts`` makes them."""
    out = np.zeros(len(keys), np.uint64)
    lens = np.array([len(k) // WORD_BYTES for k in keys], np.int64)
    start = np.array([_lang_hash(x) for x in langs], np.uint64)
    for k in np.unique(lens[lens > 0]).tolist():
        at = np.flatnonzero(lens == k)
        words = np.frombuffer(b"".join(keys[i] for i in at.tolist()), np.uint8).reshape(-1, WORD_BYTES)
        words = _first_words(words).reshape(-1, k)
        h = mix(start[at] * _MUL + words[:, 0])
        for j in range(1, k):
            h = _longer(h, words[:, j])
        out[at] = h
    return out


# --- Spark -------------------------------------------------------------------------

def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "key", "word").agg(F.sum("c").alias("c"))


def _grams(batches):
    for b in small_batches(batches, BATCH_BYTES):
        g = Grams(b.column(0), b.column(1))
        if len(g.idx):
            yield g


def _map(value) -> np.ndarray:
    return np.frombuffer(value.value, np.uint8)


def _gathered(parts: DataFrame, bits: int, least: int) -> bytes:
    """Bitmap of the numbers that occur ``least`` times in ``parts``:
    ``range`` (high bits), ``low`` (two bytes each). The driver gets the
    bitmap, whose size is bounded."""
    def run(batches):
        now, held = None, None
        for b in released(batches):
            for r, low in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if r != now:
                    if now is not None:
                        yield full(now, held)
                    now, held = r, np.zeros(1 << RANGE_BITS, np.int64)
                held += np.bincount(np.frombuffer(low.as_buffer(), "<u2"), minlength=1 << RANGE_BITS)
        if now is not None:
            yield full(now, held)

    def full(r, held):
        data = np.packbits(held >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([data], pa.binary())], names=["range", "bits"])

    n = common.shuffle_partitions(parts.sparkSession)
    got = parts.repartition(n, "range").sortWithinPartitions("range").mapInArrow(run, "range int, bits binary").collect()
    out, step = bytearray(1 << (bits - 3)), 1 << (RANGE_BITS - 3)
    for r in got:
        out[r["range"] * step:(r["range"] + 1) * step] = r["bits"]
    return bytes(out)


def _ranges(h: np.ndarray, bits: int, most: int) -> tuple[np.ndarray, list[bytes]]:
    """(range, low two bytes of its numbers) of hashes; a number is listed
    at most ``most`` times."""
    at = np.sort((h & np.uint64((1 << bits) - 1)).astype(np.uint32))
    if len(at) > most:
        keep = np.ones(len(at), bool)
        keep[most:] = at[most:] != at[:-most]
        at = at[keep]
    part = at >> np.uint32(RANGE_BITS)
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(at) else np.zeros(0, np.int64)
    low = (at & np.uint32((1 << RANGE_BITS) - 1)).astype("<u2")
    return part[cut].astype(np.int32), [low[i:j].tobytes() for i, j in zip(cut.tolist(), [*cut.tolist()[1:], len(at)], strict=False)]


def bitmap(phrases: DataFrame, bits: int) -> bytes:
    """Bitmap of ``2 ** bits`` bits with one for each phrase (``lang, key``)."""
    def places(batches):
        for b in released(batches):
            part, low = _ranges(_key_hashes(b.column(0).to_pylist(), b.column(1).to_pylist()), bits, 1)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(low, pa.binary())], names=["range", "low"])

    rows = phrases.filter(F.length("key") > 0).select("lang", "key")
    return _gathered(rows.mapInArrow(places, "range int, low binary"), bits, 1)


def _bits(n: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, int(n).bit_length()))


def proposals(docs: DataFrame, least: int, longest: int, share: float, seed: int) -> tuple[DataFrame, int]:
    """(``lang, key, ...`` of S, words of all documents, about): phrases of
    the sample that reach the lowered threshold, longer ones of parts that do."""
    spark, t = docs.sparkSession, lowered(least, share)
    sample = docs.filter(F.rand(seed) < share)
    found, member = None, None
    for low, high in ((1, 1), (2, 2), (3, longest)):
        def run(batches, member=member, low=low, high=high):
            for g in _grams(batches):
                yield from proposed(g, None if member is None else _map(member), low, high)

        if high < low or low > longest:
            break
        more = common.written(_summed(sample.mapInArrow(run, COUNT_SCHEMA)).filter(F.col("c") >= t), "phrase-sample")
        if member is None:
            words = more.agg(F.sum("c")).first()[0] or 0
        else:
            member.unpersist()
        found = more if found is None else found.unionAll(more)
        member = spark.sparkContext.broadcast(bitmap(found, _bits(32 * found.count())))
    member.unpersist()
    return found, int(words / share)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     longest: int = LONGEST, share: float = SAMPLE, seed: int = 13) -> DataFrame:
    """``lang, key, word, c`` of every phrase of 1 to ``longest`` words with
    at least ``least`` occurrences in its language (``word`` for single
    ones), and of the empty phrase, which occurs once per word.

    Null texts are empty, a null language is ``und``; repeated rows count
    again; an empty table has no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = spread(docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang")))
    known, words = proposals(docs, least, longest, share, seed)
    member = spark.sparkContext.broadcast(bitmap(known, _bits(32 * known.count())))
    bits = _bits(words // 2)

    def count(batches):
        for g in _grams(batches):
            rows, border = counted(g, _map(member), longest)
            for b in rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())],
                                                 names=[*b.schema.names, "range", "low"])
            part, low = _ranges(border, bits, least)
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
                 pa.array(part, pa.int32()), pa.array(low, pa.binary())], names=[*rows[0].schema.names, "range", "low"])

    def expand(batches):
        for g in _grams(batches):
            yield from expanded(g, _map(member), _map(full), longest)

    raw = common.written(docs.mapInArrow(count, f"{COUNT_SCHEMA}, range int, low binary"), "phrase-pass")
    found = _frequent(_summed(raw.filter("range is null").select("lang", "key", "word", "c")), least)
    full = spark.sparkContext.broadcast(_gathered(raw.filter("range is not null").select("range", "low"), bits, least))
    if any(full.value):                             # border failures, or buckets of several phrases
        found = found.unionAll(_frequent(_summed(docs.mapInArrow(expand, COUNT_SCHEMA)), least))
    full.unpersist()
    member.unpersist()
    return found


def _frequent(counts: DataFrame, least: int) -> DataFrame:
    return common.written(counts.filter((F.col("c") >= least) | (F.length("key") == 0)), "phrase-counts")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, top: int = TOP, percent: int = 100, share: float = SAMPLE,
                 seed: int = 13) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases
    of each language by score.

    A phrase of 2 to ``longest`` words scores ``floor(1000 * a * n / (l * r))``
    at the cut that scores lowest (ties: the first). A phrase inside a
    longer one that has at least ``percent`` % of its occurrences is left
    out. Arithmetic is exact (38 digits). Null texts are empty, a null
    language is ``und``, ties in score and occurrences go by phrase, an
    empty table has no rows.
    """
    found = common.written(frequent_phrases(docs, text_col, lang_col, least, longest, share, seed), "phrase-frequent")
    f = found.select("lang", "key", "c")
    width = F.length("key")
    many = f.filter(width > WORD_BYTES)
    # a part of k - 1 words of a longer phrase; parts of parts follow by the same rule
    inner = (many.filter(width > 2 * WORD_BYTES)
             .select("lang", F.explode(F.array(F.expr(f"substring(key, 1, length(key) - {WORD_BYTES})"),
                                               F.expr(f"substring(key, {WORD_BYTES + 1})"))).alias("key"),
                     F.col("c").alias("longer"))
             .groupBy("lang", "key").agg(F.max("longer").alias("longer")))
    alone = (many.join(inner, ["lang", "key"], "left")
             .filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("c"))).drop("longer"))
    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), (width / WORD_BYTES - 1).cast("int"))))
    cuts = (cuts.withColumn("first", F.expr(f"substring(key, 1, {WORD_BYTES} * k)"))
            .withColumn("rest", F.expr(f"substring(key, {WORD_BYTES} * k + 1)"))
            .join(f.select("lang", F.col("key").alias("first"), F.col("c").alias("l")), ["lang", "first"])
            .join(f.select("lang", F.col("key").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
            .join(f.filter(width == 0).select("lang", F.col("c").alias("n")), "lang"))
    big = "cast({} as decimal(19,0))".format
    score = F.expr(f"(cast(1000 as decimal(4,0)) * ({big('c')} * {big('n')})) div ({big('l')} * {big('r')})")
    scored = (cuts.groupBy("lang", "key", "c", "n")
              .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))
              .select("lang", "key", F.col("c").alias("a"), "n", "s.l", "s.r", "s.score"))
    scored = common.written(scored, "phrase-scored")
    names = found.filter(width == WORD_BYTES).select("lang", F.col("key").alias("one"), "word")
    place = F.posexplode(F.expr(f"transform(sequence(0, cast(length(key) / {WORD_BYTES} as int) - 1),"
                                f" i -> substring(key, {WORD_BYTES} * i + 1, {WORD_BYTES}))"))
    texts = (scored.select("lang", "key", place.alias("at", "one")).join(names, ["lang", "one"])
             .groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
             .select("lang", "key", F.concat_ws(" ", F.col("w.word")).alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (scored.join(texts, ["lang", "key"]).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= F.lit(top))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
