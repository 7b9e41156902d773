"""Column expressions (JVM side, whole-stage codegen friendly)."""

from tagloom.functions.arrays import count_map_get, first_n, merge_count_maps, sort_counts_desc
from tagloom.functions.tokens import blank_split
from tagloom.functions.timecols import to_instant, to_wall_clock

__all__ = ["blank_split", "to_instant", "to_wall_clock",
           "sort_counts_desc", "first_n", "count_map_get", "merge_count_maps"]
