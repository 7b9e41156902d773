"""Event-time windowed counts on a stream, and top-K per closed window.

The count is Spark's state-store aggregation keyed by (window, tag), so
the state and the work spread over all shuffle partitions. In append
mode a window's rows leave the state store together, in the micro-batch
where the watermark passes the window end; ranking them inside
``foreachBatch`` is therefore exact, and uses the batch WindowGroupLimit
plan (at most K rows per window leave each task).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.timecols import to_instant, to_wall_clock
from tagloom.operators.counting import tokenize
from tagloom.operators.partitioning import spread
from tagloom.operators.topk import group_top_k, top_k


@contextmanager
def state_partitions(spark, n: int | None):
    """Start a stream with ``n`` state partitions.

    A stream clones its session when it starts, and its state-store
    partitions follow ``spark.sql.shuffle.partitions`` at that moment
    (then fixed by the checkpoint). The setting is changed only around
    ``start()`` and restored right after, so batch queries keep theirs.
    """
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def event_time(df: DataFrame, time_col: str, out: str = "event_time") -> DataFrame:
    """Add a TIMESTAMP event-time column (watermarks reject TIMESTAMP_NTZ)."""
    t = df.schema[time_col].dataType.simpleString()
    c = to_instant(time_col) if t == "timestamp_ntz" else F.col(time_col).cast("timestamp")
    return df.withColumn(out, c)


def window_counts(stream: DataFrame, time_col: str, key: str, size: str,
                  slide: str | None = None, delay: str = "0 seconds",
                  wall_clock: bool = True) -> DataFrame:
    """Streaming ``(window_start, window_end, tag, cnt)``, append mode.

    Rows behind the watermark (max event time seen minus ``delay``) are
    dropped, as with a bounded-out-of-orderness watermark of ``delay``.
    """
    ev = event_time(stream.select(time_col, F.col(key).alias("tag")), time_col)
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    counts = (ev.withWatermark("event_time", delay)
              .groupBy(w.alias("window"), "tag").agg(F.count(F.lit(1)).alias("cnt")))
    conv = to_wall_clock if wall_clock else (lambda c: F.col(c))
    return counts.select(conv("window.start").alias("window_start"),
                         conv("window.end").alias("window_end"), "tag", "cnt")


def start_to_parquet(stream_df: DataFrame, out: str, checkpoint: str,
                     trigger: dict | None = None, mode: str = "append"):
    """Start writing a stream to a parquet folder (exactly-once file sink)."""
    trigger = trigger or {"availableNow": True}
    return (stream_df.writeStream.format("parquet").outputMode(mode)
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def start_window_outputs(counts: DataFrame, checkpoint: str, k: int = 10, rows: str | None = None,
                         report: str | None = None, keyed: bool = False, chart: str | None = None,
                         trigger: dict | None = None):
    """Top-k of each window as it closes, to any of several outputs.

    One query reads the source and keeps the window state once; its
    micro-batches are ranked once and written to

    * ``rows``: the ranked rows as Parquet, ``batch_id=N`` folders;
    * ``report``: the text report, oldest window first, ``batch_id=N``
      folders (``keyed``: the variant that names the window end);
    * ``chart``: the chart JSON of the newest closed window, in place.

    Folders are overwritten, so a batch replayed after a failure replaces
    its own output. A failing output fails the query.
    """
    from tagloom.sinks.reports import keyed_topk_report, topk_json, topk_report
    trigger = trigger or {"availableNow": True}

    def write(batch: DataFrame, batch_id: int) -> None:
        ranked = group_top_k(batch, ["window_start", "window_end"], k)
        several = (rows is not None) + (report is not None) + 2 * (chart is not None) > 1
        if several:         # rank the micro-batch once, not once per output
            ranked = ranked.persist()
        try:
            if rows is not None:
                ranked.write.mode("overwrite").parquet(f"{rows}/batch_id={batch_id}")
            if report is not None:
                rep = (keyed_topk_report(ranked) if keyed
                       else topk_report(ranked, ["window_start", "window_end"]))
                (rep.orderBy("window_end").select("report")
                 .write.mode("overwrite").text(f"{report}/batch_id={batch_id}"))
            if chart is not None:
                newest = ranked.groupBy().agg(F.max("window_end").alias("_last"))
                latest = ranked.join(newest, F.col("window_end") == F.col("_last")).drop("_last")
                out = topk_json(latest, ["window_end"]).select("json")
                if not out.isEmpty():
                    out.coalesce(1).write.mode("overwrite").text(chart)
        finally:
            if several:
                ranked.unpersist()

    return (counts.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_window_top_k(counts: DataFrame, out: str, checkpoint: str, k: int = 10,
                       trigger: dict | None = None):
    """Ranked rows of each closed window (see ``start_window_outputs``)."""
    return start_window_outputs(counts, checkpoint, k, rows=out, trigger=trigger)


def start_window_report(counts: DataFrame, out: str, checkpoint: str, k: int = 10,
                        keyed: bool = False, trigger: dict | None = None):
    """Text report of each closed window (see ``start_window_outputs``)."""
    return start_window_outputs(counts, checkpoint, k, report=out, keyed=keyed, trigger=trigger)


def start_chart_feed(counts: DataFrame, path: str, checkpoint: str, k: int = 10,
                     trigger: dict | None = None):
    """Chart JSON of the newest closed window (see ``start_window_outputs``)."""
    return start_window_outputs(counts, checkpoint, k, chart=path, trigger=trigger)


def start_interval_top_k(lines: DataFrame, out: str, checkpoint: str, k: int = 10,
                         text_col: str = "value", trigger: dict | None = None):
    """Per micro-batch word count and top-k (no state carried over).

    Production runs use ``trigger={"processingTime": "3 seconds"}``.
    """
    trigger = trigger or {"availableNow": True}

    def write(batch: DataFrame, batch_id: int) -> None:
        # a batch from few files / topic partitions is spread over all cores
        counts = tokenize(spread(batch), text_col).groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"))
        top_k(counts, k).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (lines.select(text_col).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def tag_events(lines: DataFrame, text_col: str = "value", time_col: str | None = "timestamp") -> DataFrame:
    """Line -> ``(tag, ts)`` per token. ``ts`` is the record's own time
    (e.g. the broker timestamp) or, with ``time_col=None``, the
    micro-batch time, which is one value per batch."""
    t = F.current_timestamp() if time_col is None else F.col(time_col)
    return tokenize(lines.select(text_col, t.alias("ts")), text_col, keep=["ts"])


def late_row_report(batch_counts: DataFrame, stream_counts: DataFrame) -> DataFrame:
    """Windows/tags the stream counted lower than a batch run over the same
    input: ``dropped`` = rows lost to the watermark."""
    keys = ["window_start", "window_end", "tag"]
    s = stream_counts.select(*keys, F.col("cnt").alias("stream_cnt"))
    return (batch_counts.select(*keys, F.col("cnt").alias("batch_cnt")).join(s, keys, "left")
            .withColumn("stream_cnt", F.coalesce("stream_cnt", F.lit(0)))
            .withColumn("dropped", F.col("batch_cnt") - F.col("stream_cnt"))
            .filter(F.col("dropped") > 0))


def start_console(stream_df: DataFrame, num_rows: int = 10, mode: str = "append",
                  trigger: dict | None = None):
    """Print the first ``num_rows`` rows of each micro-batch."""
    w = stream_df.writeStream.format("console").outputMode(mode).option("numRows", num_rows)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def run_until_done(query) -> None:
    """Block until an availableNow / once query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
