"""Count lists held in one value (e.g. a chart feed read back)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sort_counts_desc(items, name: str = "name", count: str = "count") -> Column:
    """Sort an ``array<struct<name, count>>`` by count desc, then name asc."""
    c = F.col(items) if isinstance(items, str) else items

    def cmp(a, b):
        return (F.when(a[count] > b[count], F.lit(-1)).when(a[count] < b[count], F.lit(1))
                .when(a[name] < b[name], F.lit(-1)).when(a[name] > b[name], F.lit(1))
                .otherwise(F.lit(0)))
    return F.array_sort(c, cmp)


def first_n(items, n: int) -> Column:
    """The first ``n`` elements (all of them when fewer)."""
    c = F.col(items) if isinstance(items, str) else items
    return F.slice(c, 1, n)


def count_map_get(m, key, default: int = 0) -> Column:
    """``map[key]`` of a tag -> count map, ``default`` when absent."""
    c = F.col(m) if isinstance(m, str) else m
    return F.coalesce(F.try_element_at(c, key if isinstance(key, Column) else F.lit(key)), F.lit(default))


def merge_count_maps(a, b) -> Column:
    """Add two tag -> count maps of one row (a key in one map only keeps
    its count). For counts spread over rows use ``merge_counts``."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.map_zip_with(ca, cb, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
