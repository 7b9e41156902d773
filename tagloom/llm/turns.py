"""Repair of conversation structure by depth-first branch and bound.

A conversation is sound if the first letters of its roles read
``s?(ua)+`` or nothing. Rows may be kept, given the role that fits
(``REROLE``), deleted (``DELETE``; blank and duplicate rows must be), and
empty turns inserted (``INSERT``); a truncated row that stays costs
``TRUNCATED``. The cheapest edits win, equal costs by the edits' initials
(D, I, K, R) in ASCII order.

The search keeps an explicit stack of prefixes (row, role before it, cost,
edits). A prefix is dropped if its cost and a lower bound of what its
suffix costs exceed the incumbent, or if a prefix that led to the same
node (row and role before it) was no dearer: children are tried in ASCII
order, so that one has the lesser edits too. The bound adds what each row
costs whatever its neighbours are, and the cost of misfits between
neighbours, of which no two share a row (best choice by weights).

Rows are ordered by Spark over ranges, so a conversation of any length
lies in many partitions. It is searched in chunks of ``CHUNK`` rows: a
chunk's best edits from each role before it to each role after it are
found on their own, and the chunks' tables are joined in order; a
conversation of one chunk is one search. Texts meet their edits chunk by
chunk as well. Only one-byte codes are searched, never texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.llm.tokens import released, small_batches
from tagloom.operators.indexing import group_position

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
CHUNK = 64                  # rows searched together
CACHED = 20_000             # searches a worker remembers (a memory bound)
ROLES = {"u": "user", "a": "assistant"}
# codes: 4 * letter of the role + fault
LETTERS = "sua?"
FINE, BLANK, DUPLICATE, CUT = range(4)
# the role before a row: none yet, system, user, assistant
NONE, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = "uuau"              # what may follow each
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {"su", "ua", "au"}


def _flip(role: str) -> str:
    return "a" if role == "u" else "u"


class _Bound:
    """Least cost of the rows from each one on, by the role before it."""

    def __init__(self, letters: str, faults: list[int], goals: tuple[int, ...]):
        n = len(letters)
        self.base, self.free = [0] * (n + 1), [0] * (n + 1)
        self.fixed, self.loose, self.cheap = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        rows = [i for i in range(n) if faults[i] not in (BLANK, DUPLICATE) and letters[i] in "ua"]
        self.roles = [letters[i] for i in rows]
        self.fixed[n] = len(rows)
        for i in reversed(range(n)):
            forced, cut = faults[i] in (BLANK, DUPLICATE), TRUNCATED * (faults[i] == CUT)
            loose = not forced and letters[i] not in "ua"
            fixed = not forced and not loose
            cost = DELETE if forced else min(DELETE, REROLE + cut) if loose else cut
            self.base[i] = self.base[i + 1] + cost
            self.free[i] = max(self.free[i + 1], REROLE * (loose and letters[i] == "s"))
            self.fixed[i] = self.fixed[i + 1] - fixed
            # rows without a usable role up to the next one that has it
            self.loose[i] = 0 if fixed else self.loose[i + 1] + loose
            self.cheap[i] = False if fixed else self.cheap[i + 1] or bool(loose and cut)
        self.last = {ASSISTANT: "u", USER: "a"}.get(max(goals), None)
        self.match = [0] * (len(rows) + 2)
        for j in reversed(range(len(rows))):
            self.match[j] = max(self.match[j + 1], self._misfit(_flip(self.roles[j]), rows[j] + 1, j + 1) + self.match[j + 2])

    def _misfit(self, wanted: str, i: int, j: int) -> int:
        """Extra cost between a place where ``wanted`` has to come and the
        next row ``j`` with a role (or the end), from row ``i`` on."""
        follow = self.roles[j] if j < len(self.roles) else self.last
        if self.loose[i] % 2:
            wanted = _flip(wanted)
        if follow is None or wanted == follow:
            return 0
        return min(INSERT, REROLE) if not self.loose[i] else 0 if self.cheap[i] else DELETE - REROLE

    def of(self, i: int, state: int) -> int:
        if state == NONE:
            return max(0, self.base[i] - self.free[i])
        j = self.fixed[i]
        return self.base[i] + max(self.match[j], self._misfit(_NEXT[state], i, j) + self.match[j + 1])


def _children(letters, faults, i, state, dead):
    """(edit, next row, next role, role made, cost) in ASCII order."""
    n = len(letters)
    if i < n:
        yield "D", i + 1, state, "-", DELETE
    role = _NEXT[state]
    if not dead:
        yield "I", i, _AFTER[role], role, INSERT
    if i < n and faults[i] not in (BLANK, DUPLICATE):
        cut = TRUNCATED * (faults[i] == CUT)
        if letters[i] == role or letters[i] == "s" and state == NONE:
            if not dead or letters[i] == "s":
                yield "K", i + 1, _AFTER[letters[i]], letters[i], cut
        if letters[i] != role and not dead:         # a role that fits is never changed
            yield "R", i + 1, _AFTER[role], role, REROLE + cut


def search(letters: str, faults: list[int], start: int = NONE, goals: tuple[int, ...] = (NONE, ASSISTANT)):
    """(cost, edits, roles made) that lead from role ``start`` before the
    rows to one of ``goals`` after them, or None."""
    n, bound = len(letters), _Bound(letters, faults, goals)
    dead = max(goals) <= SYSTEM                     # no user or assistant may be made

    def passable(state):
        return state <= max(goals) or max(goals) > SYSTEM

    # a first incumbent's cost: the child with the least cost and bound, all the way
    i, state, cost = 0, start, 0
    for _ in range(2 * n + 4):
        if i == n and state in goals:
            break
        options = [(cost + c + bound.of(j, s), e, j, s, cost + c) for e, j, s, _, c in _children(letters, faults, i, state, dead)
                   if passable(s)]
        if not options:
            break
        _, _, i, state, cost = min(options)
    limit = cost if i == n and state in goals else (DELETE + INSERT) * n + 3 * INSERT
    best, least = None, {}
    stack = [(0, start, 0, None)]
    while stack:
        i, state, cost, path = stack.pop()
        top = cost + bound.of(i, state)
        if top > limit or best is not None and top == limit:
            continue
        if cost >= least.get((i, state), cost + 1):
            continue                                # a prefix that is no dearer and whose edits come first
        least[i, state] = cost
        if i == n and state in goals:
            best, limit = (cost, path), cost
            continue
        for e, j, s, made, c in reversed(list(_children(letters, faults, i, state, dead))):
            if passable(s):
                stack.append((j, s, cost + c, (path, e, made)))
    if best is None:
        return None
    edits, made, path = [], [], best[1]
    while path is not None:
        path, e, m = path
        edits.append(e)
        made.append(m)
    return best[0], "".join(reversed(edits)), "".join(reversed(made))


_SEEN: dict = {}


def _searched(codes: bytes, start: int, goals: tuple[int, ...]):
    key = (codes, start, goals)
    if key not in _SEEN:
        if len(_SEEN) >= CACHED:
            _SEEN.clear()
        _SEEN[key] = search("".join(LETTERS[c >> 2] for c in codes), [c & 3 for c in codes], start, goals)
    return _SEEN[key]


def _illegal(codes: bytes) -> int:
    return sum(LETTERS[a >> 2] + LETTERS[b >> 2] not in _LEGAL for a, b in zip(codes, codes[1:], strict=False))


# --- Spark -------------------------------------------------------------------------

def _rows(turns: DataFrame, conv_col, turn_col, role_col, text_col) -> DataFrame:
    """The rows with their ``pos`` in the conversation (nulls: one space)."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    return common.written(group_position(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"]), "turn-rows")


def _coded(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, code``: the role's letter and the row's first fault."""
    role, text = F.col("role"), F.col("text")
    letter = F.substring(role, 1, 1)
    light = common.written(rows.select(
        "conv_id", "pos", F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("same"),
        F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3).alias("letter"),
        (~text.rlike(common.WORD)).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut")), "turn-light")
    firsts = common.written(light.filter("not blank").groupBy(F.col("conv_id").alias("c"), F.col("same").alias("s"))
                            .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
                            "turn-firsts")
    both = light.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
             .when(F.col("cut"), CUT).otherwise(FINE))
    return both.select("conv_id", "pos", (4 * F.col("letter") + fault).cast("tinyint").alias("code"))


SOLVED = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, made string"
_TABLE = "conv_id long, chunk long, codes binary, start int, goal int, cost long, audit string, made string"


def _bytes(a) -> bytes:
    return a.values.to_numpy().tobytes()


def _counted(codes: bytes) -> list[int]:
    return [sum(c & 3 == f for c in codes) for f in (BLANK, DUPLICATE, CUT)] + [_illegal(codes)]


def _whole(batches):
    for b in released(batches):
        out = [(conv, *_counted(codes), *_searched(codes, NONE, (NONE, ASSISTANT)))
               for conv, codes in zip(b.column(0).to_pylist(), map(_bytes, b.column(1)), strict=True)]
        yield _solved(out)


def _solved(out) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    cols = list(zip(*out, strict=True)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=[f.split()[0] for f in SOLVED.split(", ")])


def _tables(batches):
    """Best edits of a chunk from each role to each role."""
    for b in released(batches):
        for conv, chunk, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), map(_bytes, b.column(2)), strict=True):
            out = [(conv, chunk, codes, s, g, *found) for s in range(4) for g in range(4) if s <= g or s > SYSTEM and g > SYSTEM
                   for found in (_searched(codes, s, (g,)),) if found]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=[f.split()[0] for f in _TABLE.split(", ")])


def _joined(batches):
    """Tables of a conversation's chunks, in order, to its best edits."""
    now = object()
    chunk = best = new = count = last = None

    def step():
        return {g: min(v) for g, v in new.items()}

    def close():
        cost, audit, made = min(v for g, v in step().items() if g in (NONE, ASSISTANT))
        return _solved([(now, *count, cost, audit, made)])

    for b in released(batches):
        for conv, at, codes, s, g, cost, audit, made in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if conv != now or chunk != at:
                if new is not None and conv != now:
                    yield close()
                if conv != now:
                    best, count, last = {NONE: (0, "", "")}, [0, 0, 0, 0], b""
                else:
                    best = step()
                now, chunk, new = conv, at, {}
                count = [x + y for x, y in zip(count, _counted(codes), strict=True)]
                count[3] += _illegal(last + codes[:1]) if last else 0
                last = codes[-1:]
            if s in best:
                c, a, m = best[s]
                new.setdefault(g, []).append((c + cost, a + audit, m + made))
    if new is not None:
        yield close()


def _pieces(chunk: int):
    """Edits cut to the chunks of rows they belong to; inserted turns go
    with the row after them, at the end with the last chunk."""
    def run(batches):
        for b in released(batches):
            out = []
            for conv, audit, made in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows = np.frombuffer(audit.encode(), np.uint8) != ord("I")
                cuts = (np.flatnonzero(rows)[chunk - 1::chunk] + 1).tolist()
                if cuts and not rows[cuts[-1]:].any():
                    cuts.pop()
                for i, (x, y) in enumerate(zip([0, *cuts], [*cuts, len(audit)], strict=True)):
                    out.append((conv, i, audit[x:y], made[x:y]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 4,
                                                (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                names=["conv_id", "chunk", "audit", "made"])
    return run


REPAIRED = "conv_id long, pos long, sub int, edit string, role string, text string"


def _applied(batches):
    """A chunk's edits come before its rows; what they leave."""
    audit, made, at = "", "", 0
    for b in small_batches(batches):
        out = []
        for conv, pos, edits, roles, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if edits is not None:
                audit, made, at = edits, roles, 0
                continue
            sub = 0
            while audit[at] == "I":
                out.append((conv, pos, sub, "I", ROLES[made[at]], ""))
                at, sub = at + 1, sub + 1
            if audit[at] != "D":
                out.append((conv, pos, sub, audit[at], role if audit[at] == "K" else ROLES[made[at]], text))
            at, sub = at + 1, sub + 1
            if audit[at:at + 1] == "I" and not audit[at:].strip("I"):       # the last row
                out += [(conv, pos, sub + j, "I", ROLES[m], "") for j, m in enumerate(made[at:])]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 6, kinds, strict=True)],
                                         names=[f.split()[0] for f in REPAIRED.split(", ")])


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(repaired rows, one report per conversation).

    Rows: ``conv_id, pos, sub`` (their order), ``edit`` (K, R or I), ``role,
    text``. Report: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit``.

    Rows are ordered by turn (null first), equal ones by role and text; a
    null role or text is one space; rows without a conversation id form
    one conversation. A row's first fault counts: blank (no character but
    space and tab to carriage return), duplicate (role and text seen
    earlier), truncated (last other character not ``.!?``). A role counts by
    its first letter; an empty role fits nowhere. ``gaps`` are turns missing
    between the least and the largest (null turns aside). An empty table
    has neither rows nor reports; other columns are not read.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count_distinct("turn")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).alias("g"))
    gaps = gaps.select("conv_id", F.col("g").try_cast("long").alias("gaps"))
    chunk = F.floor(F.col("pos") / CHUNK).cast("long")
    codes = F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"])
    chunks = common.written(_coded(rows).groupBy("conv_id", chunk.alias("chunk")).agg(codes.alias("codes")), "turn-chunks")
    long_ = common.written(chunks.filter("chunk > 0").select(F.col("conv_id").alias("c")).distinct(), "turn-long")
    is_long = F.col("conv_id").eqNullSafe(F.col("c"))
    solved = chunks.join(long_, is_long, "left_anti").select("conv_id", "codes").mapInArrow(_whole, SOLVED)
    tables = chunks.join(long_, is_long, "left_semi").select("conv_id", "chunk", "codes").mapInArrow(_tables, _TABLE)
    joined = tables.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(_joined, SOLVED)
    solved = common.written(solved.unionAll(joined), "turn-solved")
    none = F.lit(None).cast("string")
    edits = (solved.select("conv_id", "audit", "made")
             .mapInArrow(_pieces(CHUNK), "conv_id long, chunk long, audit string, made string")
             .select("conv_id", (F.col("chunk") * CHUNK).alias("pos"), "audit", "made", none.alias("role"), none.alias("text"),
                     F.lit(0).alias("kind")))
    texts = rows.select("conv_id", "pos", none.alias("audit"), none.alias("made"), "role", "text", F.lit(1).alias("kind"))
    n = common.shuffle_partitions(turns.sparkSession)
    fixed = (edits.unionAll(texts).repartition(n, F.col("conv_id"), F.floor(F.col("pos") / CHUNK))
             .sortWithinPartitions("conv_id", "pos", "kind")
             .select("conv_id", "pos", "audit", "made", "role", "text").mapInArrow(_applied, REPAIRED))
    report = (solved.withColumnRenamed("conv_id", "c").join(gaps, is_long, "left")
              .select(F.col("c").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))
    return fixed, report


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by the crc32 of
    ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops the row, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role
    user."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                      F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    what = F.crc32(key) % 20
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), what.alias("what")).filter("what != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("what") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


DIGESTS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def digests(convs: DataFrame, rows: DataFrame, report: DataFrame) -> DataFrame:
    """The report of every conversation in ``convs`` (``conv_id``; zeros and
    no edits where nothing is left of it) with the sha256 of its repaired
    ``role:text`` lines. Lines meet in order in one task, which keeps a
    running hash only."""
    def run(batches):
        now, state, done = object(), None, []

        def close():
            done.append((now, *state[0], state[1], state[2].hexdigest()))

        for b in small_batches(batches):
            for conv, kind, nums, s, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        close()
                    now, state, first = conv, [[0] * 6, "", hashlib.sha256()], True
                if kind == 1:
                    state[0], state[1] = nums, s
                elif kind == 2:
                    state[2].update((("" if first else "\n") + s + ":" + text).encode())
                    first = False
            if done:
                yield _digested(done)
                done = []
        if state is not None:
            close()
            yield _digested(done)

    none, nums = F.lit(None).cast("string"), F.lit(None).cast("array<bigint>")
    place = [F.lit(0).cast("long").alias("pos"), F.lit(0).alias("sub")]
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = (convs.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
             .select("conv_id", F.lit(0).alias("kind"), *place, nums.alias("nums"), none.alias("s"), none.alias("text"))
             .unionAll(report.select("conv_id", F.lit(1), *place, F.array(*numbers), "audit", none))
             .unionAll(rows.select("conv_id", F.lit(2), "pos", "sub", nums, "role", "text")))
    return (parts.repartition(common.shuffle_partitions(convs.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "kind", "pos", "sub")
            .select("conv_id", "kind", "nums", "s", "text").mapInArrow(run, DIGESTS))


def _digested(done) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)],
                                      names=[f.split()[0] for f in DIGESTS.split(", ")])
