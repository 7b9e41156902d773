import glob
import json
import xml.etree.ElementTree as ET

import pytest
from conftest import fixture_path
from tagloom.operators import components, counting, topk
from tagloom.operators.graph import Graph
from tagloom.sinks.gexf import gexf_lines, write_gexf
from tagloom.sinks.text import token_chunks, write_token_chunks
from tagloom.sources import objects
from tagloom.sources.pages import extract_questions, extract_records


def test_read_concat_objects(spark):
    df = objects.read_concat_objects(spark, fixture_path("questions_concat.txt"))
    recs = [r["record"] for r in df.orderBy("text").collect()]
    assert len(recs) == 4 and all(r is not None for r in recs)
    by_link = {r["links"]: r for r in recs}
    assert by_link["292357"]["tags"] == ["git", "version-control", "git-pull", "git-fetch"]
    # a title wrapped over two lines as adjacent literals is joined
    assert by_link["11227809"]["questions"][0].endswith("faster than processing an unsorted array?")
    tags = counting.count_values(objects.question_tags(df.select("record.*")))
    assert {r["tag"]: r["cnt"] for r in tags.collect()}["git"] == 3


def _literals(n):
    texts = ["plain", "x}{y", "it's {", '"}{"', "back\\\\slash}", "line\nbreak", "}", "{'a': '}'}", "é}{ü", "'" * 3 + "}" + '"' * 2, ""]
    return [{"links": str(i), "views": str(7 * i), "votes": [texts[(i + 3) % len(texts)]],
             "questions": [texts[i % len(texts)], "t" * (i % 50)], "tags": [f"t{i % 5}"]} for i in range(n)]


@pytest.mark.parametrize("split", [1500, 1 << 20])
def test_objects_are_whole_over_all_splits(spark, tmpdir_path, split):
    rows = _literals(120)
    for name, part in (("a.txt", rows[:80]), ("b.txt", rows[80:119]), ("c.txt", rows[119:]), ("empty.txt", [])):
        with open(f"{tmpdir_path}/{name}", "w") as f:
            f.write("".join(repr(r) + ["", "", " ", "\n"][i % 4] for i, r in enumerate(part)))
    with open(tmpdir_path + "/a.txt", "a") as f:
        f.write("{'links': 'cut off', 'tags': ['x}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = objects.read_concat_objects(spark, tmpdir_path).collect()
        with open(tmpdir_path + "/items.json", "w") as f:
            json.dump({"items": rows}, f, indent=1)
        with open(tmpdir_path + "/none.json", "w") as f:
            f.write('{"items": []}\n')
        items = objects.read_items_json(spark, [tmpdir_path + "/items.json", tmpdir_path + "/none.json"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bad = [r for r in got if r["record"] is None]
    assert [r["text"] for r in bad] == ["{'links': 'cut off', 'tags': ['x}"]
    good = sorted((r["file"], r["block"], r["id"], r["record"]) for r in got if r["record"] is not None)
    assert [(r["links"], r["votes"], r["questions"], r["tags"]) for *_, r in good] == [
        (r["links"], r["votes"], r["questions"], r["tags"]) for r in rows]
    assert sorted((r["links"], r["questions"]) for r in items) == sorted((r["links"], r["questions"]) for r in rows)


def test_items_and_chart_json(spark):
    items = objects.read_items_json(spark, fixture_path("questions_items.json"))
    assert items.count() == 3
    top = topk.top_k(counting.count_values(objects.question_tags(items)), 2).orderBy("rnk").collect()
    assert [(r["tag"], r["cnt"]) for r in top] == [("git", 2), ("version-control", 2)]
    typed = objects.typed_questions(items)
    assert dict(typed.dtypes)["views"] == "bigint"
    chart = objects.read_chart_json(spark, fixture_path("chart.json")).collect()
    assert [(r["name"], r["count"]) for r in chart][0] == ("python", 488)


def test_gexf_round_trip_with_escaping(spark, tmpdir_path):
    g = Graph(spark.createDataFrame([(1, 'a&b <c> "d"'), (2, "plain")], "id long, label string"),
              spark.createDataFrame([(1, 2, 7), (2, 2, 1)], "src long, dst long, weight long"))
    out = tmpdir_path + "/g.gexf"
    write_gexf(g, out)
    text = "\n".join(open(p, encoding="utf-8").read().rstrip("\n")
                     for p in sorted(glob.glob(out + "/part-*")) if open(p).read())
    root = ET.fromstring(text)
    ns = {"g": "http://www.gexf.net/1.2draft"}
    nodes = {n.get("id"): n.get("label") for n in root.iter("{%s}node" % ns["g"])}
    edges = [(e.get("source"), e.get("target"), e.get("weight")) for e in root.iter("{%s}edge" % ns["g"])]
    assert nodes == {"1": 'a&b <c> "d"', "2": "plain"}
    assert sorted(edges) == [("1", "2", "7"), ("2", "2", "1")]
    assert gexf_lines(g).count() == 4 + 2 + 2 + 2 + 3


def test_token_chunks_201_per_file(spark, tmpdir_path):
    for n, want in ((201, [201]), (202, [201, 1])):
        toks = spark.createDataFrame([(i // 50, i % 50, f"t{i}") for i in range(n)],
                                     "doc long, pos long, tag string")
        chunks = token_chunks(toks, ["doc", "pos"]).orderBy("chunk").collect()
        assert [len(r["text"].split(" ")) - 1 for r in chunks] == want
        assert chunks[0]["text"].startswith("t0 t1 t2 ") and chunks[0]["text"].endswith(" ")
    out = tmpdir_path + "/tags"
    write_token_chunks(token_chunks(toks, ["doc", "pos"]), out, folders=True)
    assert sorted(p.rsplit("/", 1)[1] for p in glob.glob(out + "/chunk=*")) == ["chunk=0", "chunk=1"]
    write_token_chunks(token_chunks(toks, ["doc", "pos"]), out + "-rows")
    assert sorted(r["chunk"] for r in spark.read.json(out + "-rows").collect()) == [0, 1]


def test_component_lines_split_big_components(spark):
    comp = spark.createDataFrame([(i, 0) for i in range(10)] + [(20, 20), (21, 20)],
                                 "id long, component long")
    lines = components.isolated_groups(comp, max_members_per_line=3).collect()
    small = [r for r in lines if r["component"] == 20]
    assert len(small) == 1 and small[0]["members"] == "20, 21" and small[0]["chunk"] == 0
    big = [r for r in lines if r["component"] == 0]
    members = sorted(int(x) for r in big for x in r["members"].split(", "))
    assert members == list(range(10)) and len(big) > 1


def test_extract_records_from_pages(spark):
    html = ('<html><head><title>T1</title></head><body><nav><ul><li><a href="/git">git</a></li>'
            '<li><a href="/sql">sql</a></li></ul></nav><article><h1>H</h1></article></body></html>')
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    r = extract_records(pages).collect()[0]
    assert (r["title"], r["heading"], r["tags"], r["links"]) == ("T1", "H", ["git", "sql"], ["git", "sql"])


def test_extract_questions_listing(spark):
    block = ('<div class="question-summary" id="q{n}"><div class="statscontainer">'
             '<span class="vote-count-post "><strong>{v}</strong></span>'
             '<div class="status answered"><strong>{a}</strong></div>'
             '<div class="views " title="{views} views"></div></div>'
             '<div class="summary"><h3><a href="/questions/{n}/slug" class="question-hyperlink">Q{n}</a></h3>'
             '<ul><li class="d-inline mr4 js-post-tag-list-item"><a href="/t/x">x{n}</a></li></ul></div></div>')
    html = "<div id=\"questions\">" + "".join(block.format(n=n, v=n, a=1, views="1,234") for n in (7, 8)) + "</div>"
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    q = extract_questions(pages).orderBy("block_no").collect()
    assert [r["links"] for r in q] == ["7", "8"]
    assert q[0]["views"] == "1234" and q[0]["tags"] == ["x7"] and q[0]["questions"] == ["Q7"]


def test_keyed_report_and_component_writer(spark, tmpdir_path):
    import datetime as dt
    from tagloom.operators import windows
    from tagloom.sinks.reports import keyed_topk_report
    from tagloom.sinks.text import write_components
    t = dt.datetime(2024, 1, 1, 3)
    ev = spark.createDataFrame([(t, "x"), (t, "x"), (t, "y")], "ts timestamp_ntz, tag string")
    rep = keyed_topk_report(windows.window_top_k(ev, "ts", "tag", "1 day", None, 10)).collect()[0]["report"]
    assert rep == ("---------------------\n 窗口结束时间： 2024-01-02 00:00:00.0\n"
                   "No. 1 tag: x 出现数目：2\nNo. 2 tag: y 出现数目：1\n------------------\n")
    comp = spark.createDataFrame([(3, 1), (1, 1), (7, 7)], "id long, component long")
    write_components(comp, tmpdir_path + "/iso")
    lines = sorted(ln.strip() for p in glob.glob(tmpdir_path + "/iso/part-*") for ln in open(p) if ln.strip())
    assert lines == ["1, 3", "7"]


def test_document_chunks_equal_token_chunks(spark):
    from tagloom.operators.counting import tokenize
    from tagloom.sinks.text import document_token_chunks
    docs = spark.createDataFrame(
        [(d, " ".join(f"w{d}_{i}" for i in range(n))) for d, n in ((3, 150), (1, 120), (2, 0), (7, 90))]
        + [(9, "   ")], "doc_id long, text string")
    a = document_token_chunks(docs).orderBy("chunk").collect()
    toks = tokenize(docs, "text", keep=["doc_id"], with_pos=True)
    b = token_chunks(toks, ["doc_id", "pos"]).orderBy("chunk").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert len(a) == 2 and a[0]["text"].startswith("w1_0 w1_1 ")


def test_weighted_offsets(spark):
    from tagloom.operators.indexing import weighted_offsets
    df = spark.createDataFrame([(k, w) for k, w in ((5, 2), (1, 3), (9, 0), (4, 1))], "k long, w long")
    got = {r["k"]: r["off"] for r in weighted_offsets(df, ["k"], "w", "off", num_partitions=3).collect()}
    assert got == {1: 0, 4: 3, 5: 4, 9: 6}


def test_write_records_round_trip_and_graph_persist(spark, tmpdir_path):
    from tagloom.sinks.text import write_records
    recs = objects.read_concat_objects(spark, fixture_path("questions_concat.txt")).select("record.*")
    write_records(recs, tmpdir_path + "/q")
    back = spark.read.schema(objects.QUESTION_SCHEMA).json(tmpdir_path + "/q")
    key = ["links", "views", "tags"]
    assert sorted(map(tuple, back.select(key).collect())) == sorted(map(tuple, recs.select(key).collect()))
    typed = objects.typed_questions(back).collect()
    assert all(isinstance(r["views"], int) for r in typed)
    g = Graph(spark.createDataFrame([(1, "a")], "id long, label string"),
              spark.createDataFrame([(1, 1, 2)], "src long, dst long, weight long")).persist()
    assert g.vertices.is_cached and g.edges.is_cached
    g.unpersist()


def test_console_sink_runs(spark, tmpdir_path):
    import os
    from tagloom.streaming import windowed
    from tagloom.streaming.sources import text_lines_stream
    src = tmpdir_path + "/in"
    os.makedirs(src)
    with open(src + "/a.txt", "w") as f:
        f.write("a b\n")
    q = windowed.start_console(counting.tokenize(text_lines_stream(spark, src)), 10,
                               trigger={"availableNow": True})
    windowed.run_until_done(q)


def _appended(spark, path, per_chunk):
    from tagloom.sinks.text import read_token_chunks
    return {r["chunk"]: r["text"] for r in read_token_chunks(spark, path, per_chunk).collect()}


def test_appended_chunks_equal_one_run(spark, tmpdir_path):
    from tagloom.sinks.text import append_token_chunks, document_token_chunks, read_token_chunks
    texts = ["a b c", "", None, "d", "e f g h i j k l", "  m", "n o"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = tmpdir_path + "/chunks"
    assert read_token_chunks(spark, path, 4).count() == 0

    def run(n, lo, hi):
        append_token_chunks(docs.filter((docs.doc_id >= lo) & (docs.doc_id < hi)), path, n, per_chunk=4)

    def whole(hi):
        return {r["chunk"]: r["text"] for r in document_token_chunks(docs.filter(docs.doc_id < hi), per_chunk=4).collect()}

    for n, lo, hi in ((0, 0, 0), (1, 0, 1), (2, 1, 4), (3, 4, 4), (7, 4, 5), (8, 5, 7)):    # no tokens, a full chunk, a gap
        run(n, lo, hi)
        assert _appended(spark, path, 4) == whole(hi), n
    run(8, 5, 7)                                                        # the last run repeated
    assert _appended(spark, path, 4) == whole(7)
    with pytest.raises(ValueError):
        run(7, 4, 5)


def test_uncommitted_run_is_ignored_and_repeated(spark, tmpdir_path):
    from tagloom.session import drop_scratch
    from tagloom.sinks.text import append_token_chunks
    path = tmpdir_path + "/chunks"
    for n, text in enumerate(["a b c", "d e f"]):
        append_token_chunks(spark.createDataFrame([(n, text)], "doc_id long, text string"), path, n, per_chunk=2)
    drop_scratch(spark, path + "/tails/run=1")                          # failed after its chunks
    assert _appended(spark, path, 2) == {0: "a b ", 1: "c "}
    append_token_chunks(spark.createDataFrame([(5, "x")], "doc_id long, text string"), path, 1, per_chunk=2)
    assert _appended(spark, path, 2) == {0: "a b ", 1: "c x "}
