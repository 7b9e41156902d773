"""Streaming sources: a folder of files, or a message topic."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import is_file


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Files appearing under ``path`` as a stream (parquet, json, text, ...).

    Without a schema the schema of the files already there is used (a
    metadata read; no data is scanned).
    """
    if schema is None and fmt != "text":
        schema = spark.read.format(fmt).load(path).schema
    r = spark.readStream.format(fmt)
    if is_file(spark, path):
        # A file source watches a folder: watch the file's folder and
        # admit only files with this name.
        r = r.option("pathGlobFilter", os.path.basename(path))
        path = os.path.dirname(path)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def text_lines_stream(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Line-per-record text files as a stream with column ``value``."""
    return file_stream(spark, path, "text", None, max_files_per_trigger)


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest", min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict:
    """Options of a one-topic subscription with string values.

    ``min_partitions`` splits topic partitions over more tasks than the
    topic has partitions; ``max_offsets_per_trigger`` bounds one
    micro-batch, so a backlog is worked off in batches of known size.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str = "wordcount",
                group_id: str | None = None, starting_offsets: str = "latest",
                min_partitions: int | None = None,
                max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A topic as a stream of ``value STRING, timestamp TIMESTAMP``.

    Needs the spark-sql-kafka package on the classpath; each executor
    reads its own topic partitions.
    """
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(bootstrap_servers, topic, group_id, starting_offsets,
                              min_partitions, max_offsets_per_trigger).items():
        r = r.option(k, v)
    return message_value(r.load())


def message_value(records: DataFrame) -> DataFrame:
    """Record -> its value as text, with the broker timestamp."""
    return records.select(F.col("value").cast("string").alias("value"), "timestamp")
