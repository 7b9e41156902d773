"""Property tests: many random inputs checked in one Spark job each."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.functions.tokens import blank_split
from tagloom.operators import components
from tagloom.operators.graph import Graph


def jvm_split(s: str) -> list[str]:
    """String.split(" ") of the JVM: split on every blank, then drop the
    trailing empty strings (all of them for a string of blanks only)."""
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if s != "" else [""]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" ab\t\n", max_size=12), min_size=50, max_size=200))
def test_blank_split_matches_jvm_split(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, value string")
    got = {r["i"]: r["t"] for r in df.select("i", blank_split("value").alias("t")).collect()}
    assert all(got[i] == jvm_split(s) for i, s in enumerate(strings))


def _union_find(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in range(n)}


@settings(max_examples=4, deadline=None)
@given(st.integers(min_value=0, max_value=10**6))
def test_components_match_union_find_on_random_graphs(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randrange(20, 120)
    m = rnd.randrange(0, 2 * n)
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
    g = Graph(spark.createDataFrame([(i, "") for i in range(n)], "id long, label string"),
              spark.createDataFrame([(a, b, 1) for a, b in edges] or [], "src long, dst long, weight long"))
    got = {r["id"]: r["component"] for r in components.connected_components(g).collect()}
    assert got == _union_find(n, edges)
