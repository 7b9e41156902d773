"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import zlib
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import scratch_path

# Word separators of the contracts: space and the control characters tab
# to carriage return. A word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select(*(cols or ("*",)))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it
    back: lineage ends at files every executor can read, and the planner
    knows the table's real size (so it only broadcasts what is small)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a ``row`` number, stored once (see ``written``). Numbers
    follow the splits of the scan that makes them, and splits follow the
    cores registered at that moment; two scans may number rows differently.
    Whoever tells rows apart by number reads them from this table only."""
    return written(df.select(F.monotonically_increasing_id().alias("row"), *df.columns), name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_column(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (names
    compare without case, as Spark's do)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --- crc32 of concatenated byte strings --------------------------------------

def _times(mat: list[int], vec: int) -> int:
    out, i = 0, 0
    while vec:
        if vec & 1:
            out ^= mat[i]
        vec >>= 1
        i += 1
    return out


def _squared(mat: list[int]) -> list[int]:
    return [_times(mat, m) for m in mat]


@cache
def _zero_bits(k: int) -> list[int]:
    """The linear map on a crc32 of appending ``2 ** k`` zero bits."""
    return [0xEDB88320] + [1 << i for i in range(31)] if k == 0 else _squared(_zero_bits(k - 1))


def crc32_concat(crc1: int, crc2: int, len2: int) -> int:
    """crc32 of A+B from crc32(A), crc32(B) and len(B): appending a zero
    bit is a linear map on the 32-bit state, and its squares append 2, 4,
    8 ... zero bits."""
    bits, k = 8 * len2, 0
    while bits:
        if bits & 1:
            crc1 = _times(_zero_bits(k), crc1)
        bits >>= 1
        k += 1
    return crc1 ^ crc2


def crc32_ids(ids) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())

