"""Keyed window state with event-time timers.

A key is (window, sub-group of tags), so a window is no single key and its
state spreads over all state partitions. The state holds the sub-group's
counts; a timer at the window's end emits them as a list, largest first,
and clears the state. All sub-groups of a window fire in the micro-batch
whose watermark passes its end, so ranking that batch is exact.

Rows whose window was closed by an earlier micro-batch do not reach the
state: they leave the operator as ``late`` rows, judged against the
watermark the batch started with.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tagloom.functions.timecols import to_wall_clock
from tagloom.operators.topk import group_top_k
from tagloom.streaming.windowed import event_time

SUBGROUPS = 32
AHEAD = 36_500              # days; far beyond any delay, within what pandas can hold


def keyed_window_lists(stream: DataFrame, time_col: str, key: str, size: str, slide: str | None = None,
                       delay: str = "0 seconds", k: int | None = None, subgroups: int = SUBGROUPS) -> DataFrame:
    """Streaming ``kind, window_start, window_end, tag, cnt``, append mode.

    ``kind`` is ``closed`` (a tag's count in a window whose timer fired; the
    ``k`` largest of each sub-group) or ``late`` (rows of one micro-batch
    that came after their window had closed).
    """
    tag = stream.schema[key].dataType.simpleString()
    # A timer needs a watermark column beside the rows, and rows behind that
    # column are dropped unseen. So the column is the event time moved ahead,
    # which is never behind, and the delay takes the move back.
    ev = (event_time(stream.select(time_col, F.col(key).alias("tag")), time_col)
          .withColumn("ahead", F.expr(f"event_time + interval {AHEAD} days"))
          .withWatermark("ahead", f"{AHEAD} days {delay}"))
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    rows = (ev.select(w.alias("w"), "tag", "ahead")
            .select(F.unix_micros("w.start").alias("start"), F.unix_micros("w.end").alias("end"), "tag", "ahead",
                    F.pmod(F.xxhash64("tag"), F.lit(subgroups)).alias("part")))

    def out(kind, start, end, counts, most=None):
        ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0]))[:most]
        return pd.DataFrame({"kind": kind, "start": start, "end": end, "tag": [t for t, _ in ranked],
                             "cnt": [c for _, c in ranked]})

    def step(group, batches, state):
        start, end = int(group[0]), int(group[1])
        if state.hasTimedOut:
            tags, counts = state.get
            state.remove()
            yield out("closed", start, end, dict(zip(tags, counts, strict=True)), k)
            return
        new = Counter()
        for b in batches:
            new.update(b["tag"].tolist())
        if end <= state.getCurrentWatermarkMs() * 1000:
            yield out("late", start, end, new)
            return
        if state.exists:
            tags, counts = state.get
            new.update(dict(zip(tags, counts, strict=True)))
        state.update((list(new), [int(c) for c in new.values()]))
        # a timer fires once the watermark is past its time
        state.setTimeoutTimestamp(end // 1000 - 1)

    lists = rows.groupBy("start", "end", "part").applyInPandasWithState(
        step, f"kind string, start long, end long, tag {tag}, cnt long", f"tags array<{tag}>, counts array<long>",
        "append", GroupStateTimeout.EventTimeTimeout)
    wall = {c: to_wall_clock(F.timestamp_micros(c)).alias(f"window_{c}") for c in ("start", "end")}
    return lists.select("kind", wall["start"], wall["end"], "tag", "cnt")


def start_keyed_top_k(lists: DataFrame, out: str, checkpoint: str, k: int = 10, trigger: dict | None = None):
    """Ranked rows of each closed window in ``OUT/top``, rows that came too
    late in ``OUT/late``, both in ``batch_id=N`` folders that a replayed
    micro-batch overwrites."""
    trigger = trigger or {"availableNow": True}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()         # the state is stepped once for both outputs
        try:
            top = group_top_k(batch.filter("kind = 'closed'"), ["window_start", "window_end"], k).drop("kind")
            top.write.mode("overwrite").parquet(f"{out}/top/batch_id={batch_id}")
            late = batch.filter("kind = 'late'").groupBy("window_start", "window_end", "tag").agg(F.sum("cnt").alias("cnt"))
            late.write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (lists.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
