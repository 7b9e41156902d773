"""Dense 0-based ids and running totals in sort order, without a
single-partition window.

The rows are range-partitioned and sorted on the order columns, so the
partition index is the high part of the order. Every row takes its
position (or running total) inside its partition plus the total of all
earlier partitions. The per-partition totals are one number per
partition: they are read once (bounded by the partition count, never by
the data) and enter the plan as an array literal, so the final ids are a
plain projection with no join. The numbered rows are checkpointed to the
shared checkpoint folder, so a lost executor cannot renumber them.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import checkpoint

_LOW_BITS = (1 << 33) - 1


def _keys(order_cols: list) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in order_cols]


def _range_partitioned(df: DataFrame, keys: list[Column], n: int | None) -> DataFrame:
    """Range partitions in key order. Without an explicit count AQE may
    merge adjacent small ranges (order is kept), so a small input does
    not turn into hundreds of one-row partitions."""
    return df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)


def _partition_offsets(numbered: DataFrame, amount: Column) -> Column:
    """``sum(amount)`` over all partitions before this row's ``_part``."""
    totals = dict(numbered.groupBy("_part").agg(F.sum(amount).alias("t"))
                  .select("_part", "t").collect())
    n = max(totals, default=-1) + 1
    per_part = [int(totals.get(p) or 0) for p in range(n)]
    starts = [0] + list(accumulate(per_part))[:-1]
    return F.element_at(F.lit(starts).cast("array<bigint>"), F.col("_part") + 1)


def dense_id(df: DataFrame, order_cols: list, out: str = "id",
             num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based row number in ``order_cols`` order."""
    keys = _keys(order_cols)
    numbered = checkpoint(_range_partitioned(df, keys, num_partitions).sortWithinPartitions(*keys)
                          .withColumn("_part", F.spark_partition_id())
                          .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    start = _partition_offsets(numbered, F.lit(1))
    return (numbered.withColumn(out, (start + F.col("_pos")).cast("bigint"))
            .drop("_part", "_pos"))


def weighted_offsets(df: DataFrame, order_cols: list, weight_col: str, out: str = "offset",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight_col`` over all rows before this one in
    ``order_cols`` order (an exclusive running total, e.g. the index of a
    document's first token in the token order of the whole corpus).

    Same scheme as ``dense_id``. The running total inside a partition is
    an Arrow cumulative sum over its sorted rows, batch by batch: no
    second exchange, and one batch in memory.
    """
    keys = _keys(order_cols)
    ordered = (_range_partitioned(df, keys, num_partitions).sortWithinPartitions(*keys)
               .withColumn("_part", F.spark_partition_id()).withColumn("_loc", F.col(weight_col).cast("bigint")))
    at = len(ordered.columns) - 1

    def run(batches):
        total = 0
        for b in batches:
            weight = pc.fill_null(b.column(at), 0)
            upto = pc.add(pc.cumulative_sum(weight), total)
            yield b.set_column(at, "_loc", pc.subtract(upto, weight))
            if len(upto):
                total = upto[-1].as_py()

    local = checkpoint(ordered.mapInArrow(run, ordered.schema))
    start = _partition_offsets(local, F.col(weight_col))
    return (local.withColumn(out, (start + F.col("_loc")).cast("bigint"))
            .drop("_part", "_loc"))


def group_position(df: DataFrame, group_cols: list, order_cols: list, out: str = "pos",
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in its group, in
    ``order_cols`` order.

    The rows are range-partitioned on (group, order), so a giant group
    lies in many partitions. A row's position is its place in its piece
    of the group (a group within one partition) plus the rows of the
    group in earlier partitions. Only a partition's first group can have
    such rows, so one number per partition is enough.
    """
    keys = _keys(group_cols) + _keys(order_cols)
    numbered = checkpoint(_range_partitioned(df, keys, num_partitions).sortWithinPartitions(*keys)
                          .withColumn("_part", F.spark_partition_id())
                          .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    pieces = (numbered.groupBy("_part", *group_cols).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")))
    # first and last group of each partition: at most two rows per partition
    ends = (pieces.select("_part", F.struct("_first", F.struct(*group_cols).alias("g"), "_n").alias("p"))
            .groupBy("_part").agg(F.min("p").alias("first"), F.max("p").alias("last")).orderBy("_part").collect())
    carry, group, rows = {}, None, 0
    for e in ends:
        first, last = e["first"], e["last"]
        carry[e["_part"]] = rows if rows and first["g"] == group else 0
        rows = last["_n"] + (carry[e["_part"]] if last["g"] == first["g"] else 0)
        group = last["g"]
    before = F.lit([carry.get(p, 0) for p in range(max(carry, default=0) + 1)]).cast("array<bigint>")
    inside = Window.partitionBy("_part", *group_cols).orderBy("_pos")
    first = F.min("_pos").over(inside)
    return (numbered.withColumn(out, (F.col("_pos") - first + F.when(
                first == 0, F.element_at(before, F.col("_part") + 1)).otherwise(0)).cast("bigint"))
            .drop("_part", "_pos"))
