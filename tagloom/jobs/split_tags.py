"""Question records written back to back -> tag chunk files.

    python -m tagloom.jobs.split_tags --input book.json --out tags [--rejects REJ] [--folders]

Reads every record, keeps only ``tags`` and writes them, blank-separated,
201 tags per chunk, as rows ``chunk, text`` (``--folders``: one text folder
``OUT/chunk=N/`` per chunk). Tags keep their order: records in
file order, tags in list order. Unreadable record pieces go to ``REJ``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tagloom.session import get_session
from tagloom.sinks.text import token_chunks, write_records, write_token_chunks
from tagloom.sources.objects import question_tags, read_concat_objects


def run(spark, path: str, out: str, rejects: str | None = None, folders: bool = False) -> None:
    recs = read_concat_objects(spark, path)
    if rejects:
        write_records(recs.filter(F.col("record").isNull()).select("file", "text"), rejects)
    tags = question_tags(recs.filter(F.col("record").isNotNull())
                         .select("file", "block", "id", "record.*"), keep=["file", "block", "id"])
    write_token_chunks(token_chunks(tags, ["file", "block", "id", "pos"]), out, folders=folders)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--rejects")
    p.add_argument("--folders", action="store_true", help="one text folder per chunk")
    p.add_argument("--master")
    a = p.parse_args(argv)
    run(get_session(a.master, "tagloom-split-tags"), a.input, a.out, a.rejects, a.folders)


if __name__ == "__main__":
    main()
