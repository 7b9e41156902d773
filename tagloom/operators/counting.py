"""Token and value counting.

Every count is a hash aggregate with a partial (map-side) step, so a
hot token that holds a third of the rows still leaves each map task as
a single row: skew never reaches the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tokens import blank_split
from tagloom.operators.indexing import group_position


def tokenize(lines: DataFrame, text_col: str = "value", out: str = "tag",
             keep: list[str] | None = None, with_pos: bool = False) -> DataFrame:
    """Line -> one row per blank-separated token (1:N)."""
    keep = keep or []
    gen = F.posexplode if with_pos else F.explode
    names = ["pos", out] if with_pos else [out]
    return lines.select(*keep, gen(blank_split(text_col)).alias(*names))


def count_values(df: DataFrame, key: str = "tag", out: str = "cnt",
                 by: list | None = None) -> DataFrame:
    """Rows per value of ``key`` (optionally within ``by`` groups)."""
    by = by or []
    return df.groupBy(*by, key).agg(F.count(F.lit(1)).alias(out))


def token_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """word count: ``(tag, cnt)`` over all lines."""
    return count_values(tokenize(lines, text_col))


def merge_counts(*counts: DataFrame, key: str = "tag", cnt: str = "cnt",
                 by: list | None = None) -> DataFrame:
    """Add count tables: a key present in several inputs gets the sum."""
    by = by or []
    u = reduce(lambda a, b: a.unionByName(b), [c.select(*by, key, cnt) for c in counts])
    return u.groupBy(*by, key).agg(F.sum(cnt).alias(cnt))


def edge_count(pairs: DataFrame, num: int, src: str = "src", dst: str = "dst",
               out: str = "weight", by: list | None = None) -> DataFrame:
    """Occurrences per (src, dst) (within ``by`` groups), keeping counts
    strictly above ``num``."""
    by = by or []
    return (pairs.groupBy(*by, src, dst).agg(F.count(F.lit(1)).alias(out))
            .filter(F.col(out) > F.lit(num)))


def line_count(lines: DataFrame, num: int, text_col: str = "value",
               out: str = "cnt") -> DataFrame:
    """Identical raw lines counted, kept when the count exceeds ``num``."""
    return (lines.groupBy(text_col).agg(F.count(F.lit(1)).alias(out))
            .filter(F.col(out) > F.lit(num)))


def counts_as_map(counts: DataFrame, group_cols: list, key: str = "tag", cnt: str = "cnt",
                  max_keys: int = 10000) -> DataFrame:
    """Each group's counts as ``map<tag, cnt>`` (keys in ascending order).

    One rule for every size: map ``part`` (0, 1, ...) holds the keys at
    positions ``part * max_keys`` onward of the group's key order, so a
    group is the maps of its parts one after the other, and no map holds
    more than ``max_keys`` keys. ``merge_count_maps`` adds maps together.
    """
    placed = group_position(counts.select(*group_cols, key, cnt), group_cols, [key], "_at")
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col(cnt))))
    return (placed.groupBy(*group_cols, F.floor(F.col("_at") / F.lit(max_keys)).cast("bigint").alias("part"))
            .agg(F.map_from_entries(entries).alias("counts")))


def counts_as_pairs(counts: DataFrame, group_cols: list, key: str = "tag", cnt: str = "cnt",
                    max_keys: int = 10000) -> DataFrame:
    """``counts_as_map`` with each map as a list of (key, value) pairs in
    key order."""
    return (counts_as_map(counts, group_cols, key, cnt, max_keys)
            .select(*group_cols, "part", F.map_entries("counts").alias("pairs")))
