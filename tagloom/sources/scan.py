"""Objects in braces out of text files, found by a quote-aware scan that
runs on all splits of a file at once.

The text reader cuts files at every ``}``, also inside strings. Whether a
cut ends an object depends on everything before it: the quote state and the
nesting depth. So each piece is scanned from every possible quote state;
the pieces' transitions are joined within their split, one summary per
split is joined in file order, and only then the states, and with them the
object borders, are known everywhere:

1. ``value -> (state after it, braces opened)`` for each state before it:
   column expressions.
2. Packs: a split's pieces in order, some at a time, as one text with the
   cuts' places and, for each state before the split, the depth at each cut
   outside strings. A task holds one batch of pieces.
3. One row per split: the transition of the whole split from each state,
   as its last pack has it; per file, over its splits in order: state and
   depth before each split.
4. Cuts that end an object are now known in each pack. What lies between
   two of them is an object, cut out of the pack's text; only what comes
   before the first and after the last one is grouped with that of other
   packs.

No task holds a file or a split: texts are stored once, in packs, and read
pack by pack; step 3 holds one row per split of a file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.session import arrow_bytes, scratch_path

# The cut, and the quote characters of Python literals and JSON.
CUT = "}"
LITERAL_QUOTES = "'\""
JSON_QUOTES = '"'

PACK_BYTES = 256 << 10      # text of a pack
BATCH_BYTES = 8 << 20       # pieces given to Python together
_ROW_GROUP = 8 << 20        # of the packs' table: readers hold one

_KEYS = "file string, block long"
_PACK = f"{_KEYS}, id long, size long, bytes long, text binary, cuts array<int>, at array<array<int>>, state array<int>, depth array<int>"


def _after(text: Column, quotes: str) -> Column:
    """struct(state, opened) of a text that begins outside strings and has
    no escapes: state 0, or 1 + the number of the quote it ends inside."""
    whole = "|".join(f"{q}[^{q}]*{q}" for q in quotes)
    open_ = "".join(quotes)
    bare = F.regexp_replace(text, whole, "")
    tail = F.regexp_extract(bare, f"[{open_}]", 0)
    outside = F.regexp_replace(bare, f"(?s)[{open_}].*", "")
    state = F.lit(0)
    for i, q in enumerate(quotes):
        state = F.when(tail == q, i + 1).otherwise(state)
    return F.struct(state.alias("state"), F.length(F.regexp_replace(outside, r"[^{]", "")).alias("opened"))


def _transitions(value: Column, quotes: str) -> list[Column]:
    """``_after`` from each state before the piece. A backslash before the
    cut escapes the cut, so no escape crosses pieces."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    out = [_after(plain, quotes)]
    for i, q in enumerate(quotes):
        at = F.instr(plain, q)
        out.append(F.when(at > 0, _after(F.substr(plain, at + 1), quotes))
                   .otherwise(F.struct(F.lit(i + 1).alias("state"), F.lit(0).alias("opened"))))
    return out


def _states(after: np.ndarray) -> np.ndarray:
    """State after each piece by the state before the first one: running
    joins of the pieces' maps, doubling the span each step."""
    out, d = after.copy(), 1
    while d < len(out):
        out[d:] = _join(out[:-d], out[d:])
        d *= 2
    return out


def _join(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    return np.take_along_axis(then, first, axis=1)


def _runs(states: np.ndarray, opened: np.ndarray, start: int, depth: int):
    """(outside strings, depth) at the cut after each piece."""
    state = states[:, start]
    before = np.r_[start, state[:-1]].astype(np.int64)
    change = np.take_along_axis(opened, before[:, None], axis=1)[:, 0] - (state == 0)
    return state == 0, depth + np.cumsum(change)


def _lists(arrays: list, mask=None) -> pa.Array:
    ends = np.cumsum([0, *(len(a) for a in arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int32), mask=mask))


def _packed(n: int):
    """Pieces (with their cut) of splits, in order, to packs. ``at``,
    ``state`` and ``depth`` have a value for each state before the split;
    depths count from there, null inside a string."""
    def run(batches):
        key, state, depth = None, [], []
        for b in batches:
            if not b.num_rows:
                continue
            file, block, text = b.column("file"), b.column("block").to_numpy(), b.column("text")
            ids = b.column("id").to_numpy()
            after, opened = (np.stack([b.column(f"{c}{k}").to_numpy() for k in range(n)], axis=1) for c in "so")
            place = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, 4 * text.offset).astype(np.int64)
            data = text.buffers()[2]
            other = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (block[1:] != block[:-1])
            borders = [0, *(np.flatnonzero(other) + 1).tolist(), b.num_rows]
            for first, end in zip(borders, borders[1:], strict=False):
                if key != (file[first].as_py(), int(block[first])):
                    key, state, depth = (file[first].as_py(), int(block[first])), list(range(n)), [0] * n
                lo = first
                while lo < end:
                    hi = min(max(int(np.searchsorted(place, place[lo] + PACK_BYTES, "right")) - 1, lo + 1), end)
                    states = _states(after[lo:hi])
                    marks = [_runs(states, opened[lo:hi], state[k], depth[k]) for k in range(n)]
                    state, depth = [int(states[-1, s]) for s in state], [int(d[-1]) for _, d in marks]
                    at = _lists([d for _, d in marks], np.concatenate([~outside for outside, _ in marks]))
                    size = int(place[hi] - place[lo])
                    yield pa.RecordBatch.from_arrays(
                        [file.slice(lo, 1), b.column("block").slice(lo, 1), pa.array([ids[lo]], pa.int64()), b.column("size").slice(lo, 1),
                         pa.array([size], pa.int64()), pa.array([data.slice(place[lo], size).to_pybytes()], pa.binary()),
                         _lists([place[lo + 1:hi + 1] - place[lo]]), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), at),
                         _lists([np.array(state)]), _lists([np.array(depth)])],
                        names=["file", "block", "id", "size", "bytes", "text", "cuts", "at", "state", "depth"])
                    lo = hi
    return run


def _table(rows, names) -> pa.RecordBatch:
    kinds = {"file": pa.string()}
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(k, pa.int64())) for c, k in zip(cols, names, strict=True)], names=list(names))


def _starts(table: pa.Table) -> pa.Table:
    """State and depth before each split of one file."""
    state, depth, out = 0, 0, []
    for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
        out.append((r["file"], r["block"], state, depth))
        state, depth = r["state"][state], depth + r["depth"][state]
    return pa.Table.from_batches([_table(out, ("file", "block", "state", "depth"))])


def _written(df: DataFrame, name: str, **options) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_objects(spark: SparkSession, path: str, quotes: str = LITERAL_QUOTES, level: int = 0) -> DataFrame:
    """``file, block, id, text, whole``: every object whose closing brace
    leaves ``level`` open ones (0: objects written back to back; 1: objects
    in a list of one outer object), in file order by ``block, id``.

    Strings may hold braces and quotes; escapes are backslashes. ``text``
    begins where the object before it ended, so blanks, commas or the outer
    object's beginning may come first. ``whole`` is false for what is left
    at a file's end without its closing brace.
    """
    n = len(quotes) + 1
    raw = spark.read.option("lineSep", CUT).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value", F.col("_metadata.file_size").alias("size"))
    steps = raw.withColumn("t", F.array(*_transitions(F.col("value"), quotes)))
    pieces = steps.select("file", "block", "id", "size", F.concat("value", F.lit(CUT)).alias("text"), *(
        F.col("t")[k]["state"].alias(f"s{k}") for k in range(n)), *(F.col("t")[k]["opened"].alias(f"o{k}") for k in range(n)))
    with arrow_bytes(spark, BATCH_BYTES):
        packs = _written(pieces.mapInArrow(_packed(n), _PACK), "scan-packs", **{"parquet.block.size": _ROW_GROUP})
    splits = _written(packs.groupBy("file", "block").agg(
        F.max_by(F.struct("state", "depth"), "id").alias("t"), F.max("id").alias("last_id"), F.sum("bytes").alias("bytes"),
        F.max("size").alias("size")).select("file", "block", "t.*", "last_id", "bytes", "size"), "scan-splits")
    starts = splits.select("file", "block", "state", "depth").groupBy("file").applyInArrow(_starts, f"{_KEYS}, state long, depth long")
    # a file that ends with the cut is as long as its pieces with a cut each
    files = splits.groupBy("file").agg(F.max_by("last_id", "block").alias("last_id"), (F.sum("bytes") == F.max("size")).alias("closed"))
    known = _written(starts.join(files, "file").select(
        "file", "block", F.col("state").cast("int").alias("before"), (F.lit(level) - F.col("depth")).cast("int").alias("rise"),
        F.when(~F.col("closed"), F.col("last_id")).alias("open_id")), "scan-starts")
    return _gathered(packs, known)


def _gathered(packs: DataFrame, starts: DataFrame) -> DataFrame:
    """Objects within a pack as they are, the others joined from their parts."""
    # ``e``: places and numbers of the cuts that end an object; the last cut of a file may be missing
    ends = F.expr("""array_compact(transform(cuts, (c, i) ->
        if(get(get(at, before), i) = rise and not (unclosed and c = bytes), struct(c as c, i + 1 as n), null)))""")
    known = (packs.join(F.broadcast(starts), ["file", "block"])
             .withColumn("unclosed", F.coalesce(F.col("open_id") == F.col("id"), F.lit(False))).withColumn("e", ends))
    cut_out = F.substring("text", F.col("lo") + 1, F.col("hi") - F.col("lo")).cast("string").alias("text")
    within = (known.select("file", "block", "id", "text", F.explode(F.expr(
        "transform(slice(e, 2, greatest(size(e) - 1, 0)), (x, i) -> struct(get(e, i).c as lo, x.c as hi, get(e, i).n as n))")).alias("o"))
              .select("file", "block", F.col("id") + F.col("o.n"), "text", "o.lo", "o.hi").toDF("file", "block", "id", "text", "lo", "hi")
              .select("file", "block", "id", cut_out, F.lit(True).alias("whole")))
    order = Window.partitionBy("file").orderBy("block", "id").rowsBetween(Window.unboundedPreceding, -1)       # one row per pack
    marks = known.select("file", "block", "id", F.when(F.size("e") > 0, F.struct("block", "id")).alias("own"))
    carried = _written(marks.select("file", "block", "id", F.last("own", True).over(order).alias("carry")), "scan-carried")
    length = F.col("bytes") - F.col("unclosed").cast("int")
    part = F.explode(F.array(
        F.struct(F.lit(0).alias("lo"), F.coalesce(F.get("e", F.lit(0))["c"], length).cast("int").alias("hi"), F.lit(0).alias("n"),
                 (F.size("e") > 0).alias("ends"), F.lit(False).alias("begins")),
        F.struct(F.element_at("e", -1)["c"].alias("lo"), length.cast("int").alias("hi"), F.element_at("e", -1)["n"].alias("n"),
                 F.lit(False).alias("ends"), F.lit(True).alias("begins"))))
    parts = (known.withColumn("e", F.when(F.size("e") > 0, F.col("e"))).select("file", "block", "id", "text", part.alias("o"))
             .select("file", "block", F.col("id").alias("pack"), (F.col("id") + F.col("o.n")).alias("id"), "text", "o.lo", "o.hi", "o.ends", "o.begins")
             .filter("hi > lo").select("file", "block", "pack", "id", cut_out, "ends", "begins"))
    parts = (parts.join(carried.withColumnRenamed("id", "pack"), ["file", "block", "pack"])
             .withColumn("home", F.when(F.col("begins"), F.struct("block", F.col("pack").alias("id"))).otherwise(F.col("carry"))))
    several = (parts.groupBy("file", "home").agg(F.sort_array(F.collect_list(F.struct("block", "id", "text"))).alias("p"),
                                                 F.max("ends").alias("whole"))
               .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["id"].alias("id"),
                       F.array_join("p.text", "").alias("text"), "whole"))
    return within.unionAll(_written(several, "scan-several"))
