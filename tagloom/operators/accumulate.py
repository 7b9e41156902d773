"""User-defined aggregates with mergeable accumulators.

An accumulator is created, takes rows, is merged with others and gives its
result last, so a group is never held by one task: each task adds its own
rows, batch by batch, and only states travel. States of a group meet in a
tree of at most ``fan_in`` of them at a time.
"""

from __future__ import annotations

import pickle
from collections import Counter

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import scratch_path

FAN_IN = 16
HELD = 10_000               # groups whose states a task holds before it passes them on


class Accumulator:
    """What a user aggregate defines. ``merge`` must not depend on the
    order of rows or states. ``schema`` is that of the result rows."""

    schema: str

    def create(self):
        raise NotImplementedError

    def add(self, state, rows: pd.DataFrame):
        """``state`` with rows of its group (some of them, as they come)."""
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, state) -> list[tuple]:
        raise NotImplementedError

    def dump(self, state) -> bytes:
        return pickle.dumps(state)

    def load(self, data: bytes):
        return pickle.loads(data)


class ValueCounts(Accumulator):
    """Values of a column with their counts, largest first: ``pos, value,
    cnt`` (ties by value)."""

    def __init__(self, col: str, kind: str = "string"):
        self.col, self.schema = col, f"pos long, value {kind}, cnt long"

    def create(self):
        return Counter()

    def add(self, state, rows):
        state.update(rows[self.col].tolist())
        return state

    def merge(self, a, b):
        a.update(b)
        return a

    def result(self, state):
        ranked = sorted(state.items(), key=lambda x: (-x[1], x[0] is not None, x[0]))
        return [(i, v, c) for i, (v, c) in enumerate(ranked)]


class Spread(Accumulator):
    """``n, total, squares`` of a whole-number column, exactly (of any size
    while merged; as text)."""

    schema = "n long, total string, squares string"

    def __init__(self, col: str):
        self.col = col

    def create(self):
        return 0, 0, 0

    def add(self, state, rows):
        v = [int(x) for x in rows[self.col].tolist() if not pd.isna(x)]
        return state[0] + len(v), state[1] + sum(v), state[2] + sum(x * x for x in v)

    def merge(self, a, b):
        return tuple(x + y for x, y in zip(a, b, strict=True))

    def result(self, state):
        return [(state[0], str(state[1]), str(state[2]))]


def accumulate(df: DataFrame, by: list[str], acc: Accumulator, fan_in: int = FAN_IN) -> DataFrame:
    """``by`` columns and the result rows of ``acc`` for every group of ``df``.

    Null keys are groups. An empty input has no groups. States are written
    once per level of the tree, so a lost executor repeats a level only.
    """
    keys = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    held_schema = f"{keys}, _part long, _state binary"

    def frame(states: list) -> pd.DataFrame:
        part = TaskContext.get().partitionId()
        out = pd.DataFrame([k for k, _ in states], columns=by, dtype=object)
        out["_part"], out["_state"] = part, [acc.dump(s) for _, s in states]
        return out

    def add(batches):
        states: dict = {}
        for pdf in batches:
            for _, rows in pdf.groupby(by, dropna=False, sort=False):
                key = tuple(None if pd.isna(x) else x for x in rows[by].iloc[0].tolist())
                states[key] = acc.add(states[key] if key in states else acc.create(), rows)
            if len(states) > HELD:
                yield frame(list(states.items()))
                states = {}
        if states:
            yield frame(list(states.items()))

    def merged(pdf: pd.DataFrame):
        state = None
        for data in pdf["_state"]:
            other = acc.load(bytes(data))
            state = other if state is None else acc.merge(state, other)
        return state

    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.iloc[:1].copy()
        out["_part"] = out["_part"] // fan_in
        out["_state"] = [acc.dump(merged(pdf))]
        return out

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = acc.result(merged(pdf))
        names = [c.strip().split()[0] for c in acc.schema.split(",")]
        out = pd.DataFrame(rows, columns=names)
        for i, c in enumerate(by):
            out.insert(i, c, [pdf[c].iloc[0]] * len(rows))
        return out

    states = _written(df.mapInPandas(add, held_schema), "accumulate")
    parts = (states.agg(F.max("_part")).first()[0] or 0) + 1
    while parts > fan_in:
        states = _written(states.groupBy(*by, F.floor(F.col("_part") / fan_in).alias("_to"))
                          .applyInPandas(level, held_schema), "accumulate")
        parts = -(-parts // fan_in)
    return states.groupBy(*by).applyInPandas(last, f"{keys}, {acc.schema}")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
