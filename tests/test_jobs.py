import glob
import os
import random
import xml.etree.ElementTree as ET

import pytest

from conftest import fixture_path
from tagloom.jobs import graph_report, interval_top_tags, split_tags, stream_top_tags
from tagloom.sources.lines import RejectedLines


def _read_dir(path):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(path + "/part-*")))


def _write_graph_files(folder, k, names, n_edges, seed):
    rnd = random.Random(seed)
    v, e = os.path.join(folder, f"v{k}.txt"), os.path.join(folder, f"e{k}.txt")
    with open(v, "w", encoding="utf-8") as f:
        for i, name in enumerate(names):
            f.write(f"{i} {name}\n")
    with open(e, "w") as f:
        for _ in range(n_edges):
            a, b = rnd.sample(range(len(names)), 2)
            f.write(f"{a} {b}\n")
    return [v, e]


def test_graph_report_writes_all_outputs(spark, tmpdir_path):
    names = [f"tag{i}" for i in range(12)]
    files = [_write_graph_files(tmpdir_path, k, names[k:k + 9], 300, k) for k in range(3)]
    second = [_write_graph_files(tmpdir_path, 10 + k, names[:6], 120, 10 + k) for k in range(2)]
    out = tmpdir_path + "/out"
    graph_report.run(spark, out, files, 3, second, 2)
    ns = "{http://www.gexf.net/1.2draft}"
    for name in ("graph.gexf", "low_degree.gexf", "second_graph.gexf"):
        root = ET.fromstring(_read_dir(os.path.join(out, name)))
        labels = {n.get("label") for n in root.iter(ns + "node")}
        assert labels and labels <= set(names)
    comps = [ln for ln in _read_dir(os.path.join(out, "components.txt")).split("\n") if ln]
    members = sorted(int(x) for ln in comps for x in ln.split(", "))
    root = ET.fromstring(_read_dir(os.path.join(out, "graph.gexf")))
    assert members == sorted(int(n.get("id")) for n in root.iter(ns + "node"))


def test_split_tags_job(spark, tmpdir_path):
    out = tmpdir_path + "/tags"
    split_tags.run(spark, fixture_path("questions_concat.txt"), out, tmpdir_path + "/rej", folders=True)
    text = _read_dir(out + "/chunk=0")
    assert text.startswith("java c++ performance cpu-architecture branch-prediction git ")
    assert len(text.split()) == 5 + 4 + 5 + 4


def test_stream_top_tags_job_on_a_folder(spark, tmpdir_path):
    src = tmpdir_path + "/in"
    os.makedirs(src)
    for i, text in enumerate(["x y x\n", "y z\n", "q\n"]):
        path = f"{src}/f{i}.txt"
        with open(path, "w") as f:
            f.write(text)
        os.utime(path, (1_700_000_000 + 20 * i, 1_700_000_000 + 20 * i))
    stream_top_tags.main(["--source", "folder", "--path", src, "--checkpoint", tmpdir_path + "/ck",
                          "--out", tmpdir_path + "/out", "--report", tmpdir_path + "/rep",
                          "--available-now", "--size", "10 seconds", "--slide", "10 seconds",
                          "--max-files-per-trigger", "1"])
    got = sorted((r["tag"], r["cnt"]) for r in spark.read.parquet(tmpdir_path + "/out").collect())
    # two closed windows; the last file's window is still open when the input ends
    assert got == [("x", 2), ("y", 1), ("y", 1), ("z", 1)]
    assert "No. 1 tag:x The num of it is:  2" in _read_dir_all(tmpdir_path + "/rep")


def test_interval_top_tags_job_ranks_each_batch_alone(spark, tmpdir_path):
    src = tmpdir_path + "/in"
    os.makedirs(src)
    for i, text in enumerate(["x y x\n", "x z\n"]):
        with open(f"{src}/f{i}.txt", "w") as f:
            f.write(text)
        os.utime(f"{src}/f{i}.txt", (1_700_000_000 + 20 * i,) * 2)
    interval_top_tags.main(["--source", "folder", "--path", src, "--checkpoint", tmpdir_path + "/ck", "--out",
                            tmpdir_path + "/out", "--available-now", "--max-files-per-trigger", "1", "--k", "1"])
    got = sorted((r["batch_id"], r["tag"], r["cnt"]) for r in spark.read.parquet(tmpdir_path + "/out").collect())
    assert got == [(0, "x", 2), (1, "x", 1)]


def test_stream_job_writes_every_output_from_one_query(spark, tmpdir_path):
    src = tmpdir_path + "/in"
    os.makedirs(src)
    for i, text in enumerate(["x x y\n", "q\n"]):
        with open(f"{src}/f{i}.txt", "w") as f:
            f.write(text)
        os.utime(f"{src}/f{i}.txt", (1_700_000_000 + 20 * i,) * 2)
    args = ["--source", "folder", "--path", src, "--available-now", "--size", "10 seconds", "--slide", "10 seconds",
            "--max-files-per-trigger", "1", "--state-partitions", "2"]
    stream_top_tags.main([*args, "--checkpoint", tmpdir_path + "/ck", "--out", tmpdir_path + "/out", "--report",
                          tmpdir_path + "/rep", "--chart", tmpdir_path + "/chart"])
    assert "No. 1 tag:x The num of it is:  2" in _read_dir_all(tmpdir_path + "/rep")
    assert '{"name":"x","count":2}' in _read_dir(tmpdir_path + "/chart")
    assert sorted(os.listdir(tmpdir_path + "/ck/state/0"))[:2] == ["0", "1"]
    # an output that cannot be written ends the job
    open(tmpdir_path + "/file", "w").close()
    with pytest.raises(Exception, match="file"):
        stream_top_tags.main([*args, "--checkpoint", tmpdir_path + "/ck2", "--out", tmpdir_path + "/out2",
                              "--report", tmpdir_path + "/file/rep"])


def test_graph_job_rejects(spark, tmpdir_path):
    v, e = tmpdir_path + "/v.txt", tmpdir_path + "/e.txt"
    with open(v, "w") as f:
        f.write("1 a\n2 b\nbroken\n")
    with open(e, "w") as f:
        f.write("1 2\n1 2\nx 2\n")
    with pytest.raises(RejectedLines):
        graph_report.run(spark, tmpdir_path + "/out", [(v, e)], 1)
    graph_report.run(spark, tmpdir_path + "/out", [(v, e)], 1, rejects=tmpdir_path + "/rej")
    got = {(r["kind"], r["value"]) for r in spark.read.text(tmpdir_path + "/rej/graph0").collect()}
    assert got == {("vertex", "broken"), ("edge", "x 2")}


def _read_dir_all(path):
    return "".join(open(p).read() for p in glob.glob(path + "/**/part-*", recursive=True))
