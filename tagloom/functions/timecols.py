"""Wall-clock (TIMESTAMP_NTZ) <-> instant (TIMESTAMP) conversions.

Watermarks need TIMESTAMP; the test tables hold TIMESTAMP_NTZ values
that mean UTC. Both directions go through integer epoch microseconds,
so they are exact in any session time zone, DST gaps and overlaps
included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_micros(ntz) -> Column:
    """Epoch microseconds of an NTZ value read as UTC (no zone lookup:
    ``unix_timestamp`` takes NTZ fields as they are)."""
    c = _col(ntz)
    frac = (F.extract(F.lit("SECOND"), c) * F.lit(1000000)).cast("bigint") % F.lit(1000000)
    return F.unix_timestamp(c) * F.lit(1000000) + frac


def to_instant(ntz) -> Column:
    """Read an NTZ wall-clock value as a UTC instant (TIMESTAMP)."""
    return F.timestamp_micros(ntz_micros(ntz))


def to_wall_clock(ts) -> Column:
    """The UTC wall-clock value (TIMESTAMP_NTZ) of an instant."""
    secs = (F.unix_micros(_col(ts).cast("timestamp")) / F.lit(1000000)).cast("decimal(18,6)")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
