"""Checkpoint-folder rules, on a stand-in session object."""

import pytest

from tagloom.session import ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, k, default=None):
        return self.d.get(k, default)

    def set(self, k, v):
        raise AssertionError("spark.checkpoint.dir cannot be set at run time")


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self.dir = master, current

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = "file:" + d + "/uuid"


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf or {})


def test_reads_the_session_setting():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ck"})
    assert ensure_checkpoint_dir(s) == "file:hdfs:///shared/ck/uuid"


def test_keeps_a_folder_already_set():
    s = _Session("spark://cluster:7077", current="hdfs:///x/uuid")
    assert ensure_checkpoint_dir(s) == "hdfs:///x/uuid"


def test_local_session_may_use_its_own_folder():
    s = _Session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d.startswith("file:") and "tagloom-ckpt-" in d
    assert scratch_path(s, "x").startswith(d)


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))
