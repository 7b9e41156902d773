"""Partitioning helpers."""

from __future__ import annotations

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an input that has fewer partitions than a shuffle would.

    A scan of a few large unsplittable files (one parquet row group, a
    gzip file) gives a handful of tasks; heavy per-row work after it
    (tokenizing, regex extraction) would then use a handful of cores.
    A scan with at least ``min_partitions`` partitions (by default the
    session's shuffle partitions, a setting that does not depend on how
    many executors have registered) is returned unchanged: no shuffle is
    added there.
    """
    target = min_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        have = df.rdd.getNumPartitions()
    except PySparkNotImplementedError:  # Spark Connect has no RDDs: leave the plan as is
        return df
    return df if have >= target else df.repartition(target)
