"""Words of Arrow string columns as 64-bit hashes, for whole columns at
once. A word is a maximal run of characters other than space and tab to
carriage return; each distinct word of a column is hashed once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (splitmix64 finish)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets per text) of a string column
    (null: no words)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    offs = np.asarray(parts.offsets).astype(np.int64)
    enc = parts.values.slice(offs[0], offs[-1] - offs[0]).dictionary_encode()
    idx, offs = np.asarray(enc.indices).astype(np.int64), offs - offs[0]
    vocab = enc.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))
    out = hashes[idx]
    if "" in vocab:             # blanks at either end of a text give an empty piece
        keep = idx != vocab.index("")
        before = np.concatenate([[0], np.cumsum(keep)])
        out, offs = out[keep], before[offs]
    return out, offs


def shingles(hashes: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``width`` words, offsets per text); a text with
    fewer words has its whole sequence as one shingle, without words none."""
    n = np.diff(offs)
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_offs = np.concatenate([[0], np.cumsum(counts)])
    start = np.repeat(offs[:-1] - out_offs[:-1], counts) + np.arange(out_offs[-1])
    size = np.repeat(np.minimum(n, width), counts)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    h = size.astype(np.uint64)
    for k in range(width):
        h = np.where(k < size, mix(h * _MUL + padded[start + k]), h)
    return h, out_offs
