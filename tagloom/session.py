"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession

# Settings every tagloom job relies on. AQE coalesces small shuffles,
# splits skewed join partitions and turns joins into broadcasts only
# after it has measured the real size of a side.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Delete checkpoint files of DataFrames that are gone (e.g. the rounds
    # of an iterative job) from the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Window-count state lives off-heap in RocksDB; each micro-batch
    # uploads only a changelog to the checkpoint location.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tagloom",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the tagloom defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The setting is read from the session (``spark.checkpoint.dir``, or a
    folder already set on the context). Only a local session (tests,
    benchmarks) may fall back to a folder of its own; a cluster job
    without one fails loudly instead of writing to a machine-local temp
    folder. (``spark.checkpoint.dir`` itself cannot change at run time,
    so the fallback is set on the context only.)
    """
    try:
        sc = spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="tagloom-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, "tagloom", f"{name}-{uuid.uuid4().hex[:12]}")


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path in any store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def checkpoint(df):
    """Eager, reliable checkpoint into the shared checkpoint folder.

    Cuts the lineage: later jobs, and a recomputation after a lost
    executor, start from the written files. (Never ``localCheckpoint``:
    its blocks die with the executor.)
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def arrow_bytes(spark: SparkSession, most: int):
    """Batches that jobs begun meanwhile hand to Python have about ``most``
    bytes, beside Spark's limit of rows: for rows of many bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, old)
