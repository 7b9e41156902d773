"""Sorting and top-K.

Ties are broken by the key, ascending, so results are deterministic.
A global top-K takes K rows per task (TakeOrderedAndProject, any K) and
ranks only the K that remain. A per-group one ranks sub-groups first, so
that a group of any size and for any K is spread over ``SUBGROUPS`` tasks
and leaves each with at most K rows; for small K Spark also limits before
each shuffle (partial WindowGroupLimit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SUBGROUPS = 32


def sort_desc(counts: DataFrame, cnt: str = "cnt", key: str = "tag") -> DataFrame:
    return counts.orderBy(F.col(cnt).desc(), F.col(key).asc())


def top_k(counts: DataFrame, k: int = 10, cnt: str = "cnt", key: str = "tag",
          rank_col: str = "rnk") -> DataFrame:
    """The k largest counts; fewer rows when fewer keys exist."""
    w = Window.orderBy(F.col(cnt).desc(), F.col(key).asc())
    return (sort_desc(counts, cnt, key).limit(k)
            .withColumn(rank_col, F.row_number().over(w).cast("bigint")))


def group_top_k(counts: DataFrame, group_cols: list, k: int = 10,
                cnt: str = "cnt", key: str = "tag",
                rank_col: str = "rnk") -> DataFrame:
    """The k largest counts within each group (e.g. each window)."""
    order = [F.col(cnt).desc(), F.col(key).asc()]
    part = Window.partitionBy(*group_cols, "_part").orderBy(*order)
    best = (counts.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(SUBGROUPS)))
            .withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= F.lit(k)).drop("_part", "_r"))
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (best.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= F.lit(k))
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))
