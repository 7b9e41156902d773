"""Event-time windows over a batch table (tumbling and sliding)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.counting import count_values
from tagloom.operators.topk import group_top_k


def with_window(df: DataFrame, time_col: str, size: str, slide: str | None = None) -> DataFrame:
    """Assign each row to its epoch-aligned ``[start, end)`` windows."""
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return df.withColumn("window", w)


def window_count(df: DataFrame, time_col: str, key: str, size: str,
                 slide: str | None = None, out_key: str = "tag") -> DataFrame:
    """Rows per (window, key): ``window_start, window_end, tag, cnt``."""
    w = with_window(df.select(time_col, F.col(key).alias(out_key)), time_col, size, slide)
    c = count_values(w, out_key, by=["window"])
    return c.select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), out_key, "cnt")


def window_top_k(df: DataFrame, time_col: str, key: str, size: str,
                 slide: str | None = None, k: int = 10) -> DataFrame:
    """Top-k keys of every window, ranked ``rnk`` 1..k."""
    counts = window_count(df, time_col, key, size, slide)
    return group_top_k(counts, ["window_start", "window_end"], k)


def window_agg(df: DataFrame, time_col: str, size: str, slide: str | None, by: list,
               *aggs) -> DataFrame:
    """Any aggregates per (window, ``by``): built-in ones, or a grouped-agg
    pandas UDF as a user-defined aggregate. Built-ins combine map-side;
    a pandas UDF sees one group's rows, so keep ``by`` fine-grained.
    Spark runs pandas and built-in aggregates in separate calls."""
    w = with_window(df, time_col, size, slide)
    return (w.groupBy("window", *by).agg(*aggs)
            .withColumn("window_start", F.col("window.start"))
            .withColumn("window_end", F.col("window.end")).drop("window"))


def closed_windows(windowed: DataFrame, max_time, end_col: str = "window_end") -> DataFrame:
    """Keep windows a watermark at ``max_time`` has closed (end <= max)."""
    return windowed.filter(F.col(end_col) <= max_time)
