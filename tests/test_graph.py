import random

from pyspark.sql import functions as F

from conftest import fixture_path
from tagloom.operators import components, graph
from tagloom.operators.graph import Graph
from tagloom.sources.lines import edges_from_lines, graph_from_files, parse_vertices


def _load(spark, name):
    v = [(int(i), l) for i, l in (ln.rstrip("\n").split("\t", 1)
                                   for ln in open(fixture_path(f"{name}_nodes.tsv"), encoding="utf-8"))]
    e = [tuple(int(x) for x in ln.split()) for ln in open(fixture_path(f"{name}_edges.tsv"))]
    return Graph(spark.createDataFrame(v, "id long, label string"),
                 spark.createDataFrame(e, "src long, dst long, weight long"))


def _comp_sets(comp_df):
    groups = {}
    for r in comp_df.collect():
        groups.setdefault(r["component"], set()).add(r["id"])
    return sorted(groups.values(), key=lambda s: (-len(s), min(s)))


def test_golden_components(spark):
    g = _load(spark, "graph_all")
    got = _comp_sets(components.connected_components(g))
    want = [set(map(int, ln.split())) for ln in open(fixture_path("graph_all_components.txt"))]
    assert sorted(len(s) for s in got) == [2, 2, 2, 3, 3, 4, 92]
    assert sorted(map(sorted, got)) == sorted(map(sorted, want))


def test_golden_low_degree_subgraph(spark):
    g = _load(spark, "graph_all")
    assert graph.low_degree_vertices(g).count() == 56
    sub = graph.low_degree_subgraph(g)
    want = _load(spark, "graph_low")
    key = ["src", "dst", "weight"]
    assert sorted(map(tuple, sub.edges.select(key).collect())) == \
        sorted(map(tuple, want.edges.select(key).collect()))
    assert sub.vertices.count() == 108
    # 32 vertices are left without an edge, and 55 components in all
    assert components.component_sizes(components.connected_components(sub)).count() == 55


def test_golden_second_graph_with_self_loop(spark):
    g = _load(spark, "graph_second")
    sizes = sorted(r["size"] for r in components.component_sizes(components.connected_components(g)).collect())
    assert sizes == [2, 24, 41]
    deg = {r["id"]: r["degree"] for r in graph.degrees(g).collect()}
    loops = g.edges.filter("src = dst").collect()
    assert len(loops) == 1
    v = loops[0]["src"]
    others = g.edges.filter(f"src != dst and (src = {v} or dst = {v})").count()
    assert deg[v] == others + 2


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
    comp = {}
    for x in range(n):
        comp.setdefault(find(x), set()).add(x)
    return {x: min(s) for s in comp.values() for x in s}


def test_components_match_union_find(spark):
    rnd = random.Random(7)
    n = 300
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(220)]
    # a long shuffled path: many rounds for label propagation, few here
    path = list(range(n, n + 400))
    rnd.shuffle(path)
    edges += list(zip(path, path[1:]))
    total = n + 400
    g = Graph(spark.createDataFrame([(i, "") for i in range(total)], "id long, label string"),
              spark.createDataFrame([(a, b, 1) for a, b in edges], "src long, dst long, weight long"))
    got = {r["id"]: r["component"] for r in components.connected_components(g).collect()}
    assert got == _union_find(total, edges)


def test_merge_collapses_labels_and_defaults(spark):
    v1 = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "id long, label string")
    e1 = spark.createDataFrame([(1, 2, 5), (3, 2, 1), (1, 3, 2)], "src long, dst long, weight long")
    v2 = spark.createDataFrame([(10, "y"), (11, "")], "id long, label string")
    e2 = spark.createDataFrame([(10, 11, 4)], "src long, dst long, weight long")
    m = graph.merge_many([Graph(v1, e1), Graph(v2, e2)])
    ids = {r["label"]: r["id"] for r in m.vertices.collect()}
    assert ids == {"": 0, "x": 1, "y": 2}          # dense ids in label order
    got = {(r["src"], r["dst"]): r["weight"] for r in m.edges.collect()}
    # x->y: 5 + 1; x->x: a self-loop made by the collapse; y->"": 4
    assert got == {(1, 2): 6, (1, 1): 2, (2, 0): 4}


def test_merge_reverse_matches_pairwise_fold(spark):
    def g(i, a, b):
        return Graph(spark.createDataFrame([(1, a), (2, b)], "id long, label string"),
                     spark.createDataFrame([(1, 2, i)], "src long, dst long, weight long"))
    g1, g2, g3 = g(1, "a", "b"), g(2, "c", "d"), g(3, "e", "f")
    fold = graph.merge_graphs(g3, graph.merge_graphs(g1, g2, reverse=True), reverse=True)
    flat = graph.merge_many([g1, g2, g3], reverse=True)

    def labelled(m):
        lab = {r["id"]: r["label"] for r in m.vertices.collect()}
        return sorted((lab[r["src"]], lab[r["dst"]], r["weight"]) for r in m.edges.collect())
    assert labelled(fold) == labelled(flat) == [("a", "b", 1), ("c", "d", 2), ("f", "e", 3)]


def test_create_graph_from_files(spark, tmpdir_path):
    vp, ep = tmpdir_path + "/v.txt", tmpdir_path + "/e.txt"
    with open(vp, "w") as f:
        f.write("1 alpha\n2 beta extra\n2 aardvark\nbad line\n4\n")
    with open(ep, "w") as f:
        f.write("1 2\n" * 3 + "2 3\n" * 4 + "1 2 x\n" + "1 4\n")
    g = graph_from_files(spark, vp, ep, 2, rejects=tmpdir_path + "/rejects")
    assert {(r["src"], r["dst"], r["weight"]) for r in g.edges.collect()} == {(1, 2, 4), (2, 3, 4)}
    # duplicate id 2 -> least label; id 3 has no line -> ""
    assert {r["id"]: r["label"] for r in g.vertices.collect()} == {1: "alpha", 2: "aardvark", 3: ""}
    rej = parse_vertices(spark.read.text(vp)).rejects
    assert sorted(r["line"] for r in rej.collect()) == ["4", "bad line"]
    raw = edges_from_lines(spark.read.text(ep), 0, raw_line=True).rows
    assert sorted(map(tuple, raw.collect())) == [(1, 2, 1), (1, 2, 3), (1, 4, 1), (2, 3, 4)]


def test_subgraph_variants(spark):
    g = _load(spark, "graph_all")
    low = graph.low_degree_vertices(g)
    ind = graph.low_degree_induced(g)
    ids = {r["id"] for r in low.collect()}
    assert {r["id"] for r in ind.vertices.collect()} == ids
    assert all(r["src"] in ids and r["dst"] in ids for r in ind.edges.collect())
    sg = graph.subgraph(g, F.col("label").startswith("git"), F.col("weight") > 20)
    keep = {r["id"] for r in sg.vertices.collect()}
    assert all(r["src"] in keep and r["dst"] in keep and r["weight"] > 20 for r in sg.edges.collect())


def test_triplets_and_dense_id(spark):
    from tagloom.operators.indexing import dense_id
    g = _load(spark, "graph_all")
    assert graph.triplets(g).count() == 272
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(700)], "k string").repartition(4)
    ids = dense_id(df, ["k"], "id").collect()
    assert sorted(r["id"] for r in ids) == list(range(700))
    assert all(int(r["k"][1:]) == r["id"] for r in ids)


def test_hub_with_a_third_of_edges(spark):
    # one vertex on a third of all edges, plus chains that need several rounds
    rnd = random.Random(3)
    hub_edges = [(0, i) for i in range(1, 401)]
    chain = list(range(401, 1201))
    rnd.shuffle(chain)
    edges = hub_edges + list(zip(chain, chain[1:])) + [(chain[0], 5)]
    n = 1201
    g = Graph(spark.createDataFrame([(i, "") for i in range(n)], "id long, label string"),
              spark.createDataFrame([(a, b, 1) for a, b in edges], "src long, dst long, weight long"))
    got = {r["id"]: r["component"] for r in components.connected_components(g).collect()}
    assert got == _union_find(n, edges)
    deg = {r["id"]: r["degree"] for r in graph.degrees(g).collect()}
    assert deg[0] == 400


def test_components_without_edges_and_with_self_loops_only(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, label string")
    for rows in ([], [(2, 2, 5)]):
        e = spark.createDataFrame(rows, "src long, dst long, weight long")
        got = {r["id"]: r["component"] for r in components.connected_components(Graph(v, e)).collect()}
        assert got == {1: 1, 2: 2, 3: 3}


def test_contraction_keeps_components(spark):
    rng = random.Random(11)
    chain = [(i, i + 1) for i in range(299)] + [(299, i) for i in range(0, 300, 5)]     # a path and a hub
    sparse = [(rng.randrange(500), rng.randrange(500)) for _ in range(420)]
    for n, edges in ((300, chain), (500, sparse), (3, [])):
        e = spark.createDataFrame(edges, "src long, dst long").repartition(3)
        want = _union_find(n, edges)
        for block in (1 << 20, 32):
            stars = {r["v"]: r["u"] for r in components.star_edges(e, block_edges=block).collect()}
            assert {i: stars.get(i, i) for i in range(n)} == want, (n, block)


def test_contraction_needs_fewer_rounds_and_rows(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(6000)]
    e = spark.createDataFrame(edges, "src long, dst long").repartition(4)
    seen = []
    plain = components._large_star
    monkeypatch.setattr(components, "_large_star", lambda x: seen.append(x.count()) or plain(x))
    components.star_edges(e)                                            # one block holds them all
    assert seen == []
    components.star_edges(e, block_edges=256)
    contracted = list(seen)
    seen.clear()
    monkeypatch.setattr(components, "_contracted", lambda x, b: (components._undirected(x), (None, None), False))
    components.star_edges(e)
    assert contracted and sum(contracted) < sum(seen) / 4


def test_components_of_int_ids_keep_their_type(spark):
    e = spark.createDataFrame([(3, 1), (1, 2), (7, 7)], "src int, dst int")
    got = components.star_edges(e)
    assert dict(got.dtypes) == {"u": "int", "v": "int"}
    assert {(r["u"], r["v"]) for r in got.collect()} == {(1, 2), (1, 3)}
