"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Turns are put in
order by range partitions on (conversation, turn), so a conversation of
any length is spread over tasks, and each task formats whole Arrow
batches: segment lengths give cumulative offsets, numpy scatters headers
and contents into one preallocated buffer, and Arrow string offsets cut
that buffer into one chunk per conversation and batch. A conversation's
text is its chunks in ``chunk`` order.

Control strings inside texts cannot be mistaken for the template's: a
``<``, any backslashes and a ``|`` get one more backslash, which reading
takes off again. Roles also have backslash and newline escaped.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.tokens import released, small_batches

START, END = "<|im_start|>", "<|im_end|>\n"

CHUNK_SCHEMA = ("conv_id long, chunk long, n_turns long, formatted string, "
                "loss array<struct<start:long,length:long>>")


def _escaped(col: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(col, r"<(\\*)\|", r"<\\\1|")


def _escaped_role(col: pa.Array) -> pa.Array:
    col = pc.replace_substring(pc.replace_substring(col, "\\", "\\\\"), "\n", "\\n")
    return _escaped(col)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def _bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array without nulls."""
    col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data or b"", np.uint8), offs


def assemble(conv: np.ndarray, conv_null: np.ndarray, role: pa.Array, text: pa.Array, loss_role: str):
    """Formatted chunks of consecutive rows: (first row of each chunk,
    formatted strings, loss spans per chunk)."""
    role, text = pc.fill_null(role, ""), pc.fill_null(text, "")
    masked = np.asarray(pc.equal(role, loss_role))
    role, text = _escaped_role(role), _escaped(text)
    fixed = [START.encode(), None, b"\n", None, END.encode()]
    parts = [None, _bytes_of(role), None, _bytes_of(text), None]
    n = len(conv)
    lens = np.empty((n, 5), np.int64)
    for k in range(5):
        lens[:, k] = len(fixed[k]) if fixed[k] is not None else np.diff(parts[k][1])
    at = (np.cumsum(lens.ravel()) - lens.ravel()).reshape(n, 5)
    out = np.empty(int(lens.sum()), np.uint8)
    for k in range(5):
        if fixed[k] is not None:
            out[at[:, k, None] + np.arange(len(fixed[k]))] = np.frombuffer(fixed[k], np.uint8)
        else:
            data, offs = parts[k]
            src = np.arange(offs[0], offs[-1])
            out[src + np.repeat(at[:, k] - offs[:-1], lens[:, k])] = data[offs[0]:offs[-1]]
    first = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (conv_null[1:] != conv_null[:-1])])
    offsets = np.r_[at[first, 0], len(out)]
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    # Loss spans count code points from the start of their chunk.
    chars = np.empty((n, 5), np.int64)
    chars[:] = [len(START), 0, 1, 0, len(END)]
    chars[:, 1], chars[:, 3] = (np.asarray(pc.utf8_length(c)) for c in (role, text))
    pos = (np.cumsum(chars.ravel()) - chars.ravel()).reshape(n, 5)
    chunk_of = np.searchsorted(first, np.arange(n), side="right") - 1
    start = pos[:, 3] - pos[first, 0][chunk_of]
    spans = pa.StructArray.from_arrays(
        [pa.array(start[masked]), pa.array(chars[masked, 3])], names=["start", "length"])
    per = np.bincount(chunk_of[masked], minlength=len(first))
    loss = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), spans)
    return first, formatted, loss


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """Chunks of formatted conversations: ``conv_id, chunk`` (order within
    the conversation), ``n_turns, formatted, loss`` (code-point spans in
    the chunk that hold the escaped texts of ``loss_role`` turns).

    Turns are ordered by ``turn_col``, equal ones by role and text, nulls
    first; repeated rows are turns of their own. Null role or text: empty.
    Rows with a null conversation id form one conversation. An empty table
    has no chunks; other columns are not read. Memory: one Arrow batch.
    """
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"))

    def run(batches):
        chunk = TaskContext.get().partitionId() << 33
        for b in small_batches(batches):
            ids = b.column(0)
            conv, null = np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())
            first, formatted, loss = assemble(conv, null, b.column(1), b.column(2), loss_role)
            n = np.diff(np.r_[first, b.num_rows])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first)), pa.array(chunk + np.arange(len(first))), pa.array(n),
                 formatted.cast(pa.string()), loss], names=["conv_id", "chunk", "n_turns", "formatted", "loss"])
            chunk += len(first)

    n = common.shuffle_partitions(turns.sparkSession)
    return (rows.repartitionByRange(n, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
            .drop("turn").mapInArrow(run, CHUNK_SCHEMA))


def parse_chunk(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted chunk, unescaped."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.removesuffix(END).partition("\n")
        out.append((unescape_role(role), unescape(text)))
    return out


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long")


def read_back(chunks: DataFrame) -> DataFrame:
    """Parse formatted chunks and digest each conversation. Chunks of a
    conversation meet in order in one task, which keeps running hashes
    only (a digest is sequential by nature), never the conversation."""

    def run(batches):
        done, now, state = [], object(), None

        def close():
            done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in released(batches):
            for conv, formatted, loss in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse_chunk(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for s in loss:
                    text = unescape(formatted[s["start"]:s["start"] + s["length"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
            if done:
                yield _digests(done)
                done = []
        if state is not None:
            close()
            yield _digests(done)

    return (chunks.select("conv_id", "formatted", "loss", "chunk").repartition("conv_id")
            .sortWithinPartitions("conv_id", "chunk").drop("chunk").mapInArrow(run, DIGEST_SCHEMA))


def _digests(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=[f.split()[0] for f in DIGEST_SCHEMA.split(", ")])
