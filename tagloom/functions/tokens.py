"""Splitting lines into tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_split(text) -> Column:
    """Split on U+0020 the way a JVM ``String.split(" ")`` does.

    Leading and inner empty tokens are kept, trailing ones are dropped,
    and a line of blanks only gives no token at all. ``""`` gives one
    empty token. Tabs and newlines stay inside tokens. Spark's ``rtrim``
    removes exactly U+0020, so no regex runs besides the split itself.
    """
    t = _col(text)
    body = F.rtrim(t)
    return (F.when((body == F.lit("")) & (t != F.lit("")),
                   F.array().cast("array<string>"))
            .otherwise(F.split(body, " ")))

