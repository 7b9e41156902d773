import datetime as dt

from pyspark.sql import functions as F

from tagloom.operators import windows
from tagloom.sinks import reports


def _events(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, tag string")


def test_sliding_window_counts(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 7)
    ev = _events(spark, [(t, "a"), (t + dt.timedelta(seconds=6), "a"), (t, "b")])
    got = {(r["window_start"].second, r["tag"]): r["cnt"]
           for r in windows.window_count(ev, "ts", "tag", "10 seconds", "5 seconds").collect()}
    # 00:07 lies in [00:00,00:10) and [00:05,00:15); 00:13 in [00:05,00:15) and [00:10,00:20)
    assert got == {(0, "a"): 1, (5, "a"): 2, (10, "a"): 1, (0, "b"): 1, (5, "b"): 1}


def test_window_top_k_with_three_tags(spark):
    t = dt.datetime(2024, 1, 1)
    ev = _events(spark, [(t, "a"), (t, "b"), (t, "b"), (t, "c")])
    top = windows.window_top_k(ev, "ts", "tag", "1 day", None, 10).orderBy("rnk").collect()
    assert [(r["rnk"], r["tag"], r["cnt"]) for r in top] == [(1, "b", 2), (2, "a", 1), (3, "c", 1)]


def test_report_and_json_layout(spark):
    t = dt.datetime(2024, 1, 1)
    ev = _events(spark, [(t, "x"), (t, "x"), (t, "y")])
    ranked = windows.window_top_k(ev, "ts", "tag", "1 day", None, 10)
    rep = reports.topk_report(ranked, ["window_start"]).collect()[0]["report"]
    assert rep == ("----------\n"
                   "No. 1 tag:x The num of it is:  2\n"
                   "No. 2 tag:y The num of it is:  1\n"
                   "--------------------\n")
    js = reports.topk_json(ranked, ["window_start"]).collect()[0]["json"]
    assert js == '[{"name":"x","count":2},{"name":"y","count":1}]'


def test_write_topk_json_overwrites(spark, tmpdir_path):
    import glob
    t = dt.datetime(2024, 1, 1)
    ranked = windows.window_top_k(_events(spark, [(t, "q")]), "ts", "tag", "1 day", None, 10)
    out = tmpdir_path + "/chart"
    reports.write_topk_json(ranked, out)
    reports.write_topk_json(ranked, out)
    txt = "".join(open(p).read() for p in glob.glob(out + "/part-*"))
    assert txt.strip() == '[{"name":"q","count":1}]'


def test_window_agg_with_pandas_udaf(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    @F.pandas_udf("long")
    def distinct_tags(s: pd.Series) -> int:
        return int(s.nunique())

    t = dt.datetime(2024, 1, 1)
    ev = _events(spark, [(t, "a"), (t, "a"), (t, "b"), (t + dt.timedelta(days=1), "c")])
    got = windows.window_agg(ev, "ts", "1 day", None, [], distinct_tags("tag").alias("n"))
    assert [r["n"] for r in got.orderBy("window_start").collect()] == [2, 1]
    rows = windows.window_agg(ev, "ts", "1 day", None, ["tag"], F.count(F.lit(1)).alias("rows"))
    assert sorted((r["tag"], r["rows"]) for r in rows.collect()) == [("a", 2), ("b", 1), ("c", 1)]


def test_count_list_functions(spark):
    from tagloom.functions.arrays import count_map_get, first_n, sort_counts_desc
    df = spark.createDataFrame([([("b", 2), ("a", 2), ("c", 9)],)],
                               "items array<struct<name:string,count:long>>")
    r = df.select(first_n(sort_counts_desc("items"), 2).alias("top"),
                  count_map_get(F.map_from_entries("items"), "c").alias("c"),
                  count_map_get(F.map_from_entries("items"), "zz").alias("zz")).collect()[0]
    assert [(x["name"], x["count"]) for x in r["top"]] == [("c", 9), ("a", 2)]
    assert (r["c"], r["zz"]) == (9, 0)


def test_wall_clock_round_trip_in_a_dst_zone(spark):
    from tagloom.functions.timecols import to_instant, to_wall_clock
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        vals = [dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(2024, 11, 3, 1, 30, 0, 5),
                dt.datetime(2024, 1, 1)]
        df = spark.createDataFrame([(v,) for v in vals], "ts timestamp_ntz")
        r = df.select("ts", F.unix_micros(to_instant("ts")).alias("us"),
                      to_wall_clock(to_instant("ts")).alias("back")).collect()
        import calendar
        assert [x["us"] for x in r] == [calendar.timegm(v.timetuple()) * 10**6 + v.microsecond for v in vals]
        assert [x["back"] for x in r] == vals
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_merge_count_maps(spark):
    from tagloom.functions.arrays import merge_count_maps
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 5, "c": 1})],
                               "x map<string,bigint>, y map<string,bigint>")
    got = df.select(merge_count_maps("x", "y").alias("m")).collect()[0]["m"]
    assert got == {"a": 1, "b": 7, "c": 1}
