"""Top-K tags of every processing interval from a stream of text lines.

    python -m tagloom.jobs.interval_top_tags --source kafka --servers host:9092 \
        --topic wordcount --trigger "3 seconds" --k 10 --checkpoint CK --out OUT
    python -m tagloom.jobs.interval_top_tags --source folder --path IN ... --available-now

Each micro-batch is split on blanks, counted and ranked on its own; no
count is carried over. ``OUT`` gets the ranked rows, one ``batch_id=N``
folder per micro-batch.
"""

from __future__ import annotations

import argparse

from tagloom.jobs.stream_top_tags import lines_with_time, source_arguments
from tagloom.session import get_session
from tagloom.streaming import windowed


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    source_arguments(p)
    p.add_argument("--k", type=int, default=10)
    a = p.parse_args(argv)
    spark = get_session(a.master, "tagloom-interval-top-tags")
    trigger = {"availableNow": True} if a.available_now else {"processingTime": a.trigger}
    windowed.run_until_done(windowed.start_interval_top_k(
        lines_with_time(spark, a), a.out, a.checkpoint, a.k, trigger=trigger))


if __name__ == "__main__":
    main()
