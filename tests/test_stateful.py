"""Keyed state with timers, late rows, user aggregates, the custom sink and
step-by-step merging."""

import collections
import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tagloom.operators.accumulate import Accumulator, Spread, ValueCounts, accumulate
from tagloom.operators.graph import Graph, merge_graphs, merge_many, triplets
from tagloom.operators.merging import merge_into
from tagloom.streaming import keyed, sink, windowed
from tagloom.streaming.sources import file_stream

T0 = dt.datetime(2024, 1, 1)


def _file(folder, i, rows):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"part-{i:03d}.parquet")
    pq.write_table(pa.table({"ts": pa.array([T0 + dt.timedelta(seconds=s) for s, _ in rows], pa.timestamp("us")),
                             "tag": pa.array([t for _, t in rows], pa.string())}), path)
    os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def _expected(batches, size, k, delay):
    """(top rows of closed windows, late counts) of tumbling windows."""
    counts, late, mark = collections.Counter(), collections.Counter(), 0
    for rows in batches:
        for s, t in rows:
            w = s // size * size
            (late if w + size <= mark else counts)[w, t] += 1
        mark = max(mark, max(s for s, _ in rows) - delay)
    top = []
    for w in {w for w, _ in counts if w + size <= mark}:
        ranked = sorted((-c, t is not None, t) for (v, t), c in counts.items() if v == w)[:k]
        top += [(w, t, -c, i + 1) for i, (c, _, t) in enumerate(ranked)]
    return sorted(top, key=repr), sorted(((w, t, c) for (w, t), c in late.items()), key=repr)


@pytest.mark.parametrize("delay", [0, 7])
def test_timers_fire_once_and_late_rows_come_out(spark, tmpdir_path, delay):
    r = random.Random(delay)
    batches = [[(max(0, 20 * i + r.randint(-25, 19)), r.choice(["a", "b", "c", "d", "é"])) for _ in range(80)] for i in range(5)]
    for i, rows in enumerate(batches):
        _file(tmpdir_path + "/in", i, rows)
    stream = file_stream(spark, tmpdir_path + "/in", max_files_per_trigger=1)
    with windowed.state_partitions(spark, 3):
        lists = keyed.keyed_window_lists(stream, "ts", "tag", "10 seconds", delay=f"{delay} seconds", subgroups=2)
        windowed.run_until_done(keyed.start_keyed_top_k(lists, tmpdir_path + "/out", tmpdir_path + "/ck", 3))

    def start(x):
        return int((x["window_start"] - T0).total_seconds())

    top, late = _expected(batches, 10, 3, delay)
    rows = spark.read.parquet(tmpdir_path + "/out/top").collect()
    assert sorted(((start(x), x["tag"], x["cnt"], x["rnk"]) for x in rows), key=repr) == top and top
    got = spark.read.parquet(tmpdir_path + "/out/late").groupBy("window_start", "tag").agg(F.sum("cnt").alias("cnt")).collect()
    assert sorted(((start(x), x["tag"], x["cnt"]) for x in got), key=repr) == late and late
    # all lists of a window come in one micro-batch
    assert all(x[0] == 1 for x in spark.read.parquet(tmpdir_path + "/out/top").groupBy("window_start")
               .agg(F.count_distinct("batch_id")).select(F.col("count(DISTINCT batch_id)")).collect())


def test_user_aggregates_merge_in_a_tree(spark):
    rows = [(None if i % 97 == 0 else i % 3, f"t{i * i % 11}" if i % 13 else None, i - 500) for i in range(3000)]
    rows += [(7, "hot", 10**12 + i) for i in range(1500)]            # a third in one group
    df = spark.createDataFrame(rows, "g long, tag string, v long").repartition(40)
    want = collections.defaultdict(collections.Counter)
    for g, t, _ in rows:
        want[g][t] += 1
    for fan_in in (2, 16):
        got = collections.defaultdict(dict)
        for x in accumulate(df, ["g"], ValueCounts("tag"), fan_in).collect():
            got[x["g"]][x["pos"]] = (x["value"], x["cnt"])
        assert {g: dict(v.values()) for g, v in got.items()} == want
        for v in got.values():
            assert sorted(v) == list(range(len(v))) and [v[i][1] for i in range(len(v))] == sorted((c for _, c in v.values()), reverse=True)
    spread = {x["g"]: (x["n"], int(x["total"]), int(x["squares"])) for x in accumulate(df, ["g"], Spread("v"), 4).collect()}
    assert spread == {g: (len(v), sum(v), sum(x * x for x in v)) for g in want for v in ([x for h, _, x in rows if h == g],)}
    assert accumulate(df.filter("false"), ["g"], Spread("v")).count() == 0


def test_no_task_takes_more_rows_or_states_than_its_share(spark):
    class Watched(Accumulator):
        """Counts rows added by one task and states merged by one call."""
        schema = "rows long, most_added long, most_merged long"

        def create(self):
            return 0, 0, 1

        def add(self, state, rows):
            return state[0] + len(rows), state[1] + len(rows), 1

        def merge(self, a, b):
            return a[0] + b[0], max(a[1], b[1]), a[2] + 1

        def load(self, data):
            n, added, _ = super().load(data)
            return n, added, 1

        def result(self, state):
            return [state]

    df = spark.range(0, 4000, 1, 40).select(F.lit("one").alias("g"), "id")
    rows, added, merged = accumulate(df, ["g"], Watched(), fan_in=4).first()[1:]
    assert rows == 4000 and added == 100 and merged <= 4


def test_sink_publishes_once_when_a_task_fails(spark, tmpdir_path):
    flag = tmpdir_path + "/failed"

    class Flaky(sink.RichSink):
        def invoke(self, row):
            super().invoke(row)
            if row["tag"] == "bad" and not os.path.exists(flag):
                open(flag, "w").close()
                raise ValueError("lost")

    class FlakySource(sink.RichSinkSource):
        sink = Flaky

        @classmethod
        def name(cls):
            return "flaky_sink"

    batches = [[(i, f"x{i}") for i in range(50)], [(60 + i, "bad" if i == 20 else f"y{i}") for i in range(40)], [(200, "last")]]
    for i, rows in enumerate(batches):
        _file(tmpdir_path + "/in", i, rows)

    def run():
        stream = file_stream(spark, tmpdir_path + "/in", max_files_per_trigger=1)
        windowed.run_until_done(sink.start_rich_sink(stream, tmpdir_path + "/out", tmpdir_path + "/ck", source=FlakySource))

    with pytest.raises(StreamingQueryException):
        run()
    first = sink.read_rich_sink(spark, tmpdir_path + "/out", "ts timestamp_ntz, tag string")
    assert sorted(r["tag"] for r in first.collect()) == sorted(t for _, t in batches[0])
    run()
    got = sink.read_rich_sink(spark, tmpdir_path + "/out", "ts timestamp_ntz, tag string").collect()
    assert sorted(r["tag"] for r in got) == sorted(t for b in batches for _, t in b)
    assert {r["batch_id"] for r in got} == {0, 1, 2}
    # a replayed batch that is published already leaves nothing behind
    writer = sink.RichSinkWriter(tmpdir_path + "/out", sink.RichSink)
    before = sorted(os.listdir(tmpdir_path + "/out/data"))
    writer.commit([writer.write(iter(spark.createDataFrame([(1, "again")], "ts long, tag string").collect()))], 1)
    writer.abort([writer.write(iter([])), None], 9)
    assert sorted(os.listdir(tmpdir_path + "/out/data")) == before


def _labelled(spark, v, e):
    return Graph(spark.createDataFrame(v, "id long, label string"), spark.createDataFrame(e, "src long, dst long, weight long"))


def _edges(g):
    return sorted((r["src_label"], r["dst_label"], r["weight"]) for r in triplets(g).collect())


def test_merging_in_steps_keeps_known_ids(spark):
    a = _labelled(spark, [(1, "x"), (2, "y"), (3, "y")], [(1, 2, 5), (1, 3, 2)])
    b = _labelled(spark, [(9, "x"), (2, "w"), (4, "z")], [(9, 4, 1), (2, 9, 3)])
    c = _labelled(spark, [(1, "z"), (2, "a")], [(2, 1, 4), (1, 1, 1)])
    empty = _labelled(spark, [], [])
    one = merge_into(empty, a)
    two = merge_into(one, b)
    three = merge_into(merge_into(two, c), empty)
    ids = [{r["label"]: r["id"] for r in g.vertices.collect()} for g in (one, two, three)]
    assert ids[0].items() <= ids[1].items() <= ids[2].items()
    assert sorted(ids[2].values()) == list(range(5))
    assert _edges(three) == _edges(merge_many([a, b, c])) == _edges(merge_graphs(merge_graphs(a, b), c))
    assert _edges(one) == [("x", "y", 7)]
