from pyspark.sql import functions as F

from tagloom.functions.tokens import blank_split
from tagloom.operators import counting, topk


def _split(spark, s):
    df = spark.createDataFrame([(s,)], "value string")
    return df.select(blank_split("value").alias("t")).collect()[0]["t"]


def test_split_rule_matches_jvm_string_split(spark):
    # JVM "x".split(" "): trailing empties dropped, leading/inner kept,
    # all-blank -> [], "" -> [""]; only U+0020 splits.
    cases = {
        "": [""],
        "  ": [],
        " a": ["", "a"],
        "a  b ": ["a", "", "b"],
        "a\tb": ["a\tb"],
        "a b\nc": ["a", "b\nc"],
        "a": ["a"],
    }
    for s, want in cases.items():
        assert _split(spark, s) == want, repr(s)


def test_token_count_and_ties(spark):
    lines = spark.createDataFrame([("b a c",), ("a b",), ("d",)], "value string")
    counts = {r["tag"]: r["cnt"] for r in counting.token_count(lines).collect()}
    assert counts == {"a": 2, "b": 2, "c": 1, "d": 1}
    top = topk.top_k(counting.token_count(lines), 3).orderBy("rnk").collect()
    # count desc, then tag asc breaks ties
    assert [(r["rnk"], r["tag"], r["cnt"]) for r in top] == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]


def test_top_k_fewer_than_k_and_empty(spark):
    lines = spark.createDataFrame([("x y",)], "value string")
    assert topk.top_k(counting.token_count(lines), 10).count() == 2
    empty = spark.createDataFrame([], "value string")
    assert topk.top_k(counting.token_count(empty), 10).count() == 0


def test_merge_counts_adds_shared_keys(spark):
    a = spark.createDataFrame([("x", 2), ("y", 1)], "tag string, cnt long")
    b = spark.createDataFrame([("x", 3), ("z", 4)], "tag string, cnt long")
    got = {r["tag"]: r["cnt"] for r in counting.merge_counts(a, b).collect()}
    assert got == {"x": 5, "y": 1, "z": 4}


def test_group_top_k_plans_partial_limit(spark):
    df = spark.createDataFrame([(g, f"t{i}", i) for g in range(3) for i in range(30)],
                               "g int, tag string, cnt long")
    res = topk.group_top_k(df, ["g"], 5)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert res.count() == 15
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan
    assert all(r["cnt"] >= 25 for r in res.collect())


def test_line_count_threshold_is_strict(spark):
    lines = spark.createDataFrame([("1 2",)] * 3 + [("1 3",)] * 2, "value string")
    got = {r["value"]: r["cnt"] for r in counting.line_count(lines, 2).collect()}
    assert got == {"1 2": 3}


def test_hot_token_with_a_third_of_rows(spark):
    lines = spark.createDataFrame([("hot " * 2 + f"w{i}",) for i in range(3000)], "value string")
    counts = {r["tag"]: r["cnt"] for r in counting.token_count(lines).collect()}
    assert counts["hot"] == 6000 and len(counts) == 3001
    top = topk.top_k(counting.token_count(lines), 2).orderBy("rnk").collect()
    assert [(r["tag"], r["cnt"]) for r in top] == [("hot", 6000), ("w0", 1)]


def test_counts_as_map_bounded_parts(spark):
    from pyspark.sql import functions as F
    from tagloom.functions.arrays import merge_count_maps
    counts = spark.createDataFrame([(1, f"t{i}", i) for i in range(10)] + [(2, "x", 4)],
                                   "w int, tag string, cnt long")
    maps = counting.counts_as_map(counts, ["w"], max_keys=3).collect()
    small = [r for r in maps if r["w"] == 2]
    assert len(small) == 1 and small[0]["counts"] == {"x": 4} and small[0]["part"] == 0
    big = [r for r in maps if r["w"] == 1]
    assert len(big) > 1 and all(len(r["counts"]) <= 6 for r in big)
    merged = {}
    for r in big:
        merged.update(r["counts"])
    assert merged == {f"t{i}": i for i in range(10)}
    two = spark.createDataFrame([({"a": 1}, {"a": 2, "b": 3})], "x map<string,bigint>, y map<string,bigint>")
    assert two.select(merge_count_maps("x", "y").alias("m")).collect()[0]["m"] == {"a": 3, "b": 3}
