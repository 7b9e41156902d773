"""Top-K tags per sliding event-time window from a stream of text lines.

    python -m tagloom.jobs.stream_top_tags --source kafka --servers host:9092 \
        --topic wordcount --size "10 seconds" --slide "5 seconds" --k 10 \
        --checkpoint CK --out OUT [--chart CHART_DIR] [--report REPORT_DIR]
    python -m tagloom.jobs.stream_top_tags --source folder --path IN ... --available-now

Each line is split on blanks; a token's event time is the record's time
(the broker timestamp, or the file's modification time with ``--source
folder``); the watermark delay defaults to 0, so late tokens are dropped.
``OUT`` gets the ranked rows of each closed window (``batch_id=N``
folders), ``CHART_DIR`` the chart JSON of the newest window. All outputs
come from one streaming query, so a topic is read by one consumer and a
failing output ends the job.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tagloom.session import get_session
from tagloom.streaming import windowed
from tagloom.streaming.sources import kafka_lines, text_lines_stream


def lines_with_time(spark, a):
    if a.source == "kafka":
        return kafka_lines(spark, a.servers, a.topic, a.group_id, a.starting_offsets)
    # a file's arrival time: its modification time (deterministic on replay)
    return text_lines_stream(spark, a.path, a.max_files_per_trigger).select(
        "value", F.col("_metadata.file_modification_time").alias("timestamp"))


def source_arguments(p: argparse.ArgumentParser) -> None:
    """Arguments every stream job takes."""
    p.add_argument("--source", choices=["kafka", "folder"], required=True)
    p.add_argument("--servers")
    p.add_argument("--topic", default="wordcount")
    p.add_argument("--group-id")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--path")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--trigger", default="3 seconds")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--master")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    source_arguments(p)
    p.add_argument("--size", default="10 seconds")
    p.add_argument("--slide", default="5 seconds")
    p.add_argument("--delay", default="0 seconds")
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--chart")
    p.add_argument("--report", help="folder for the per-window text reports")
    p.add_argument("--keyed-report", action="store_true", help="report names the window end")
    p.add_argument("--state-partitions", type=int, help="state-store partitions (default: the session's shuffle partitions)")
    a = p.parse_args(argv)
    spark = get_session(a.master, "tagloom-stream-top-tags")
    trigger = {"availableNow": True} if a.available_now else {"processingTime": a.trigger}
    tags = windowed.tag_events(lines_with_time(spark, a))
    counts = windowed.window_counts(tags, "ts", "tag", a.size, a.slide, a.delay)
    # State partitions are fixed by the first start of a checkpoint: the
    # session's shuffle partitions, unless set for this stream.
    with windowed.state_partitions(spark, a.state_partitions):
        q = windowed.start_window_outputs(counts, a.checkpoint, a.k, a.out, a.report, a.keyed_report, a.chart, trigger)
    windowed.run_until_done(q)


if __name__ == "__main__":
    main()
