"""A custom sink with a life cycle: open, invoke, close per task; commit
publishes a micro-batch, abort cleans it up.

It is a Python data source with a streaming writer. Each task writes files
of its own names; they count only once the batch's manifest lists them. The
manifest is written last and once per batch id, so a batch that is replayed
after a failure publishes nothing twice, and files of failed tasks are
never read. Files are reached through pyarrow's file systems (local, HDFS,
S3, GCS), by URI.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

FORMAT = "tagloom_rich_sink"


def _fs(uri: str):
    """(file system, path) of a URI or a local path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class RichSink:
    """What a task does with its rows: one JSON line per row. Subclasses
    may override any step."""

    def open(self, stream) -> None:
        self.stream = stream

    def invoke(self, row) -> None:
        self.stream.write((json.dumps(row.asDict(True), default=str, ensure_ascii=False) + "\n").encode())

    def close(self) -> None:
        self.stream.close()


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class RichSinkWriter(DataSourceStreamWriter):
    def __init__(self, path: str, sink: type[RichSink]):
        self.path, self.sink = path, sink

    def write(self, iterator):
        fs, path = _fs(self.path)
        name, rows, sink = f"{uuid.uuid4().hex}.json", 0, self.sink()
        fs.create_dir(f"{path}/data", recursive=True)
        sink.open(fs.open_output_stream(f"{path}/data/{name}", compression=None))
        try:
            for row in iterator:
                sink.invoke(row)
                rows += 1
        except BaseException:
            sink.close()
            fs.delete_file(f"{path}/data/{name}")
            raise
        sink.close()
        return Written(name, rows)

    def commit(self, messages, batchId):
        fs, path = _fs(self.path)
        manifest = f"{path}/commits/{batchId}.json"
        written = [m for m in messages if m is not None]
        if fs.get_file_info(manifest).type != pafs.FileType.NotFound:       # a replay of a published batch
            self._delete(written)
            return
        fs.create_dir(f"{path}/commits", recursive=True)
        body = "".join(json.dumps({"batch_id": batchId, "file": m.file, "rows": m.rows}) + "\n" for m in written if m.rows)
        part = f"{path}/commits/_{uuid.uuid4().hex}"
        with fs.open_output_stream(part, compression=None) as f:
            f.write(body.encode())
        fs.move(part, manifest)
        self._delete([m for m in written if not m.rows])

    def abort(self, messages, batchId):
        self._delete([m for m in messages if m is not None])

    def _delete(self, written) -> None:
        fs, path = _fs(self.path)
        for m in written:
            fs.delete_file(f"{path}/data/{m.file}")


class RichSinkSource(DataSource):
    """Options: ``path`` (a folder all nodes reach)."""

    sink: type[RichSink] = RichSink

    @classmethod
    def name(cls):
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return RichSinkWriter(self.options["path"], self.sink)


def start_rich_sink(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                    source: type[RichSinkSource] = RichSinkSource):
    """Stream rows into the sink (append mode, once per row)."""
    stream.sparkSession.dataSource.register(source)
    return (stream.writeStream.format(source.name()).option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def read_rich_sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """``batch_id`` and the rows of all published batches."""
    listed = spark.read.schema("batch_id long, file string, rows long").json(f"{path}/commits").select("batch_id", "file")
    rows = spark.read.schema(schema).json(f"{path}/data").withColumn("_file", F.col("_metadata.file_name"))
    return rows.join(listed, rows["_file"] == listed["file"]).drop("_file", "file")
