"""Top-K renderings: the text report and the chart JSON array.

Both work on an already ranked top-K table, so every group they fold
into one string holds at most K rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The text report layout that consumers of the report expect.
REPORT_HEADER = "----------\n"
REPORT_LINE_PREFIX = "No. "
REPORT_TAG_LABEL = " tag:"
REPORT_COUNT_LABEL = " The num of it is:  "
REPORT_FOOTER = "--------------------\n"

# The keyed variant of the report, which names the window end.
KEYED_HEADER = "---------------------\n"
KEYED_WINDOW_END = " 窗口结束时间： "
KEYED_TAG_LABEL = " tag: "
KEYED_COUNT_LABEL = " 出现数目："
KEYED_FOOTER = "------------------\n"


def _ranked_list(ranked: DataFrame, group_cols: list, rank_col: str, fields: dict):
    """Group a ranked table into ``items`` = rank-ordered array of structs."""
    st = F.struct(F.col(rank_col).alias("r"), *[F.col(v).alias(k) for k, v in fields.items()])
    return ranked.groupBy(*group_cols).agg(F.array_sort(F.collect_list(st)).alias("items"))


def topk_report(ranked: DataFrame, group_cols: list, key: str = "tag",
                cnt: str = "cnt", rank_col: str = "rnk") -> DataFrame:
    """One report string per group (e.g. per window)."""
    g = _ranked_list(ranked, group_cols, rank_col, {"t": key, "c": cnt})
    line = lambda x: F.concat(F.lit(REPORT_LINE_PREFIX), x["r"].cast("string"),
                              F.lit(REPORT_TAG_LABEL), x["t"].cast("string"),
                              F.lit(REPORT_COUNT_LABEL), x["c"].cast("string"), F.lit("\n"))
    body = F.array_join(F.transform("items", line), "")
    return g.select(*group_cols, F.concat(F.lit(REPORT_HEADER), body,
                                          F.lit(REPORT_FOOTER)).alias("report"))


def _jvm_timestamp_text(c):
    """``yyyy-MM-dd HH:mm:ss.f...`` with trailing fraction zeros cut (at least one digit)."""
    frac = F.regexp_replace(F.date_format(c, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def keyed_topk_report(ranked: DataFrame, window_end: str = "window_end", key: str = "tag",
                      cnt: str = "cnt", rank_col: str = "rnk") -> DataFrame:
    """Report per window end, naming the window end (keyed variant)."""
    g = _ranked_list(ranked, [window_end], rank_col, {"t": key, "c": cnt})
    line = lambda x: F.concat(F.lit(REPORT_LINE_PREFIX), x["r"].cast("string"),
                              F.lit(KEYED_TAG_LABEL), x["t"].cast("string"),
                              F.lit(KEYED_COUNT_LABEL), x["c"].cast("string"), F.lit("\n"))
    return g.select(window_end, F.concat(
        F.lit(KEYED_HEADER), F.lit(KEYED_WINDOW_END), _jvm_timestamp_text(F.col(window_end)),
        F.lit("\n"), F.array_join(F.transform("items", line), ""),
        F.lit(KEYED_FOOTER)).alias("report"))


def topk_json(ranked: DataFrame, group_cols: list, key: str = "tag",
              cnt: str = "cnt", rank_col: str = "rnk") -> DataFrame:
    """``[{"name":..,"count":..},...]`` per group, highest count first."""
    g = _ranked_list(ranked, group_cols, rank_col, {"name": key, "count": cnt})
    items = F.transform("items", lambda x: F.struct(x["name"].cast("string").alias("name"),
                                                    x["count"].alias("count")))
    return g.select(*group_cols, F.to_json(items).alias("json"))


def write_topk_json(ranked: DataFrame, path: str, key: str = "tag", cnt: str = "cnt",
                    rank_col: str = "rnk") -> None:
    """Overwrite ``path`` with one JSON array (the chart feed)."""
    topk_json(ranked.withColumn("_g", F.lit(0)), ["_g"], key, cnt, rank_col) \
        .select("json").coalesce(1).write.mode("overwrite").text(path)
