"""Whole-text token ids through the ``tokenizers`` library, word by word.

The tokenizer of ``word_bpe_49k.json`` never lets a token cross white
space, so a text's ids are the ids of its white-space separated chunks,
one after the other. ``WordEncoder`` splits a whole Arrow column at once,
sends every *distinct* chunk that it has not seen to the library, and
gathers the ids of all chunks with numpy. The result equals
``Tokenizer.encode(text, add_special_tokens=False).ids`` (tested).
"""

from __future__ import annotations

import ctypes
import os
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# Punctuation cut off the end of a chunk before it is looked up (a
# run of it is one pre-token); no
# apostrophe, which the tokenizer treats on its own ('s, 't, 're ...).
_TAIL = ".,!?:;#$%&*()|"
MAX_UNITS = 300_000     # cached units per worker (a memory bound; results do not depend on it)


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes Arrow string columns; one per Python worker."""

    def __init__(self, path: str, max_units: int = MAX_UNITS):
        self.max_units = max_units
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        n = max(self.tok.get_vocab().values()) + 1
        self.dtype = np.dtype("<u2") if n <= 65536 else np.dtype("<u4")
        self.last = np.zeros(n, bool)
        for s, i in self.tok.get_vocab().items():
            self.last[i] = s.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        """Known units are Arrow strings; unit i has the ids
        ``flat[starts[i]:starts[i] + lens[i]]``."""
        self.units, self.flat = pa.array([""], pa.large_string()), np.zeros(0, self.dtype)
        self.starts, self.lens = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _one(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        ids = [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        return ids, [np.array([len(i) for i in ids], np.int64)]

    def _letters(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words made of letters only, with their counts: encoded
        many at a time, cut after each end-of-word token."""
        out, counts = [], []
        for i in range(0, len(words), 100):
            part = words[i:i + 100]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids,
                           self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):      # a letter that lower-cases into two: take them singly
                ids, n = self._one(part)
                out += ids
                counts += n
                continue
            out.append(ids[:ends[-1]])
            counts.append(np.diff(ends, prepend=0))
        return out, counts

    def _learn(self, unseen: pa.Array) -> np.ndarray:
        """Adds distinct units that are not known yet; their numbers."""
        words = unseen.to_pylist()
        alpha = np.fromiter((w.isalpha() for w in words), bool, len(words))
        order = np.concatenate([np.flatnonzero(alpha), np.flatnonzero(~alpha)])
        ids, counts = self._letters([w for w in words if w.isalpha()])
        more_ids, more_counts = self._one([w for w in words if not w.isalpha()])
        number = np.empty(len(words), np.int64)
        number[order] = len(self.units) + np.arange(len(words))
        self.units = pa.concat_arrays([self.units, unseen.take(pa.array(order))])
        self.flat = np.concatenate([self.flat, *ids, *more_ids])
        self.lens = np.concatenate([self.lens, *counts, *more_counts])
        self.starts = np.cumsum(self.lens) - self.lens
        return number

    def _chunks(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, start, length) of distinct chunks. A chunk of letters
        with closing punctuation is two units, lower-cased letters (ASCII
        only) and the punctuation; any other chunk is one unit."""
        core = pc.ascii_rtrim(vocab, characters=_TAIL)
        letters = pc.utf8_is_alpha(core)
        low = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core)
        unit = pc.if_else(letters, low, vocab)
        cut = np.flatnonzero(np.asarray(pc.and_(letters, pc.less(pc.binary_length(core),
                                                                 pc.binary_length(vocab)))))
        tail = pc.replace_substring_regex(vocab.take(pa.array(cut)), rf"^.*?([{_TAIL}]+)$", r"\1")
        enc = pa.concat_arrays([unit, tail]).dictionary_encode()
        known = pc.index_in(enc.dictionary, value_set=self.units)
        at = np.asarray(pc.fill_null(known, -1)).astype(np.int64)
        if known.null_count:
            at[at < 0] = self._learn(enc.dictionary.filter(pc.is_null(known)))
        flat, starts, lens = self.flat, self.starts[at], self.lens[at]
        idx = np.asarray(enc.indices)
        if not len(cut):
            return flat, starts[idx], lens[idx]
        # two pieces per chunk, the second mostly empty
        two = np.zeros((len(vocab), 2), np.int64)
        two[:, 0] = idx[:len(vocab)]
        n2 = np.zeros((len(vocab), 2), np.int64)
        n2[:, 0] = lens[two[:, 0]]
        two[cut, 1] = idx[len(vocab):]
        n2[cut, 1] = lens[two[cut, 1]]
        flat = gather(flat, starts[two.ravel()], n2.ravel())
        n = n2.sum(1)
        return flat, np.cumsum(n) - n, n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, ids per text) of a string column
        (null: no ids)."""
        if len(self.units) > self.max_units:
            self._forget()
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        parts = pc.ascii_split_whitespace(texts)
        offs = np.asarray(parts.offsets).astype(np.int64)
        enc = parts.values.slice(offs[0], offs[-1] - offs[0]).dictionary_encode()
        offs = offs - offs[0]
        flat, starts, lens = self._chunks(enc.dictionary)
        idx = np.asarray(enc.indices)
        wl = lens[idx]
        ends = np.concatenate([[0], np.cumsum(wl)])
        return gather(flat, starts[idx], wl), ends[offs[1:]] - ends[offs[:-1]]


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + len]``, one after the other."""
    shift = starts - (np.cumsum(lens) - lens)
    small = max(len(flat), int(lens.sum())) < 1 << 31      # 32-bit places: half the memory to move
    at = np.repeat(shift.astype(np.int32) if small else shift, lens)
    at += np.arange(len(at), dtype=at.dtype)
    return flat.take(at)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str, max_units: int = MAX_UNITS) -> WordEncoder:
    """The worker's encoder for a tokenizer file (built once per worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    _ENCODERS[path].max_units = max_units
    return _ENCODERS[path]


def with_end(ids: np.ndarray, per_text: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after every text."""
    return np.insert(ids, np.cumsum(per_text), end_id), per_text + 1


def small_batches(batches, max_bytes: int = 8 << 20):
    """Arrow batches cut so that each holds about ``max_bytes`` (a row is
    never cut)."""
    for b in released(batches):
        if not b.num_rows:
            continue
        step = max(1, int(b.num_rows * max_bytes / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, min(step, b.num_rows - i))


def released(batches):
    """The batches of a task; after the last one, memory that the worker
    holds but does not use goes back to the system, since Spark keeps idle
    workers beside other tasks."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):     # not a GNU system
            ctypes.CDLL("libc.so.6").malloc_trim(0)
