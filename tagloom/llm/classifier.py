"""Quality classifier from supervised subword embeddings.

A document is the average of learned vectors: one per word and one per
character n-gram (3 to 5 code points of ``<word>``), all hashed into one
table, plus a vector counted whenever a word repeats the word before it.
A softmax layer on the average gives the class probabilities. Table and
layer are trained by numpy stochastic gradient descent on a bounded
sample of labelled rows (``max_train``, a parameter).

For scoring, the two-class softmax on an average of vectors is a sigmoid
on an average of numbers: each table row is folded into one number, its
vector times the difference of the two class weights. Scores are the same
and every worker holds one float per table row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import small_batches

BUCKETS = 1 << 17
DIM = 16
MAX_TRAIN = 3000
BATCH_BYTES = 2 << 20       # texts whose n-grams a worker holds at a time
REPEAT_WEIGHT = 10          # a repeated word counts like so many n-grams
_REPEAT = BUCKETS           # table row of "same word as before"
_EMPTY = BUCKETS + 1        # table row every document has once (bias; all an empty text has)
ROWS = BUCKETS + 2
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MUL
    return ((h ^ (h >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int32)


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word number, table row) of every feature of distinct words."""
    words = pc.fill_null(words, "")
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    n = np.asarray(pc.utf8_length(words)).astype(np.int64) + 2
    text = "<" + "><".join(words.to_pylist()) + ">"
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(n)
    word = np.repeat(np.arange(len(n), dtype=np.int32), n)
    left = np.repeat(ends, n) - np.arange(len(cp))      # code points from here to the word's end
    h = np.zeros(len(cp), np.uint64)
    out_w, out_f = [], []
    # the whole word: position-weighted sum, then one row per n-gram size
    pos = np.arange(len(cp)) - np.repeat(ends - n, n)
    power = np.cumprod(np.full(int(n.max(initial=1)) + 1, 0x100000001B3, np.uint64))
    whole = np.add.reduceat(cp * power[pos], ends - n)
    out_w.append(np.arange(len(n), dtype=np.int32))
    out_f.append(_mix(whole))
    for k in range(5):
        at = cp[k:] + np.uint64(1)
        h[:len(at)] = h[:len(at)] * np.uint64(0x100000001B3) + at
        if k >= 2:
            ok = np.flatnonzero(left > k)
            out_w.append(word[ok])
            out_f.append(_mix(h[ok] + np.uint64(k * int(_MUL) & (2**64 - 1))))
    return np.concatenate(out_w), np.concatenate(out_f)


def split_words(texts: pa.Array):
    """(distinct words, word number of each token, tokens per text)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    offs = np.asarray(parts.offsets).astype(np.int64)
    tokens = parts.values.slice(offs[0], offs[-1] - offs[0])
    tokens = tokens.dictionary_encode()
    idx, offs = np.asarray(tokens.indices).astype(np.int64), offs - offs[0]
    # a leading or trailing blank gives an empty piece, which is no word
    empty = pc.index(tokens.dictionary, pa.scalar("", tokens.dictionary.type)).as_py()
    if empty >= 0:
        keep = idx != empty
        before = np.concatenate([[0], np.cumsum(keep)])
        idx, offs = idx[keep], before[offs]
    return tokens.dictionary, idx, offs


def _repeats(idx: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per text: ``REPEAT_WEIGHT`` times the tokens equal to the one before."""
    same = np.zeros(len(idx) + 1, np.int64)
    if len(idx) > 1:
        same[1:-1] = idx[1:] == idx[:-1]
    inner = offs[:-1][offs[:-1] < len(idx)]
    same[inner] = 0                             # the first token of a text has none before it
    total = np.concatenate([[0], np.cumsum(same[:-1])])
    return (total[offs[1:]] - total[offs[:-1]]) * REPEAT_WEIGHT


@dataclass
class Model:
    table: np.ndarray       # ROWS x DIM
    layer: np.ndarray       # DIM x 2

    def folded(self) -> np.ndarray:
        return self.table @ (self.layer[:, 1] - self.layer[:, 0])


def scores(folded: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Probability of class 1 of each text (null: empty)."""
    words, idx, offs = split_words(texts)
    w, f = word_features(words)
    value = np.bincount(w, folded[f], minlength=len(words))
    count = np.bincount(w, minlength=len(words))
    sums = np.concatenate([[0.0], np.cumsum(value[idx])]) if len(idx) else np.zeros(1)
    counts = np.concatenate([[0], np.cumsum(count[idx])]) if len(idx) else np.zeros(1, np.int64)
    rep = _repeats(idx, offs)
    total = sums[offs[1:]] - sums[offs[:-1]] + rep * folded[_REPEAT] + folded[_EMPTY]
    n = counts[offs[1:]] - counts[offs[:-1]] + rep + 1
    return 1 / (1 + np.exp(-np.clip(total / n, -50, 50)))


def document_features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct table rows, weights that sum to 1) of each text; all views
    into two arrays, so that a sample is two blocks of memory."""
    words, idx, offs = split_words(texts)
    w, f = word_features(words)
    order = np.argsort(w, kind="stable")
    w, f = w[order], f[order]
    begin = np.searchsorted(w, np.arange(len(words) + 1))
    rep, out = _repeats(idx, offs), []
    for a, b, r in zip(offs[:-1].tolist(), offs[1:].tolist(), rep.tolist(), strict=True):
        mine, times = np.unique(idx[a:b], return_counts=True)
        n = begin[mine + 1] - begin[mine]
        at = np.repeat(begin[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        rows = np.concatenate([f[at], [_REPEAT, _EMPTY]])
        weight = np.concatenate([np.repeat(times, n), [r, 1]]).astype(np.float64)
        rows, where = np.unique(rows, return_inverse=True)
        weight = np.bincount(where, weight)
        out.append((rows.astype(np.int32), (weight / weight.sum()).astype(np.float32)))
    if not out:
        return out
    rows, weights = (np.concatenate(c) for c in zip(*out, strict=True))
    ends = np.cumsum([len(r) for r, _ in out])
    return list(zip(np.split(rows, ends[:-1]), np.split(weights, ends[:-1]), strict=True))


def train(features, labels: np.ndarray, epochs: int = 6, rate: float = 1.0, seed: int = 7) -> Model:
    """Stochastic gradient descent, one document a step, with per-row
    adaptive rates. The sample is passed at least ``epochs`` times and at
    least 20,000 documents are seen."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (ROWS, DIM)).astype(np.float32)
    layer = np.zeros((DIM, 2), np.float32)
    row_sq, layer_sq = np.full(ROWS, 1e-8, np.float32), np.full((DIM, 2), 1e-4, np.float32)
    n = len(labels)
    passes = max(epochs, -(-20_000 // max(n, 1))) if n else 0
    for k in range(passes):
        step = rate * (1 - k / passes)
        for i in rng.permutation(n):
            rows, weight = features[i]
            mean = weight @ table[rows]
            z = mean @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g_mean = layer @ p
            g_layer = np.outer(mean, p)
            layer_sq += g_layer * g_layer
            layer -= step * g_layer / np.sqrt(layer_sq)
            row_sq[rows] += weight * weight * float(g_mean @ g_mean)
            table[rows] -= (step * weight / np.sqrt(row_sq[rows]))[:, None] * g_mean
    return Model(table, layer)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_train: int = MAX_TRAIN) -> Model:
    """Train on at most ``max_train`` labelled documents (the bound of this
    step: rows with the least hash of their id; the sample's ids are
    broadcast, its texts go to one task, which returns the model).

    Rows with a null id or label are left out; a document listed twice
    counts twice. Without labelled rows the model scores 0.5 everywhere.
    """
    sample = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .filter("doc_id is not null and label in (0, 1)")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text"))

    def run(batches):
        ids, features, y = [], [], []
        for b in small_batches(batches, BATCH_BYTES):
            ids += b.column(0).to_pylist()
            y += b.column(1).to_pylist()
            features += document_features(b.column(2))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], y[i], len(features[i][0])))
        m = train([features[i] for i in order], np.array([y[i] for i in order], np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.table.tobytes()], pa.binary()), pa.array([m.layer.tobytes()], pa.binary())],
            names=["table", "layer"])

    got = rows.repartition(1).mapInArrow(run, "table binary, layer binary").collect()
    if not got:
        return Model(np.zeros((ROWS, DIM), np.float32), np.zeros((DIM, 2), np.float32))
    return Model(np.frombuffer(got[0]["table"], np.float32).reshape(ROWS, DIM),
                 np.frombuffer(got[0]["layer"], np.float32).reshape(DIM, 2))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability of class 1 from the whole
    text. Null and empty texts get the model's prior. All columns of
    ``docs`` are kept; a column that is already named ``out`` is replaced."""
    folded = docs.sparkSession.sparkContext.broadcast(model.folded())

    @F.pandas_udf("double")
    def probability(text):
        import pandas as pd
        return pd.Series(np.concatenate([np.zeros(0)] + [
            scores(folded.value, b.column(0))
            for b in small_batches([pa.RecordBatch.from_arrays([pa.Array.from_pandas(text, type=pa.large_string())],
                                                               names=["text"])], BATCH_BYTES)]))

    return docs.withColumn(out, probability(F.col(text_col)))
