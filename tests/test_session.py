"""Shared-folder lookup."""

from argent.session import scratch_path, shared_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Ctx:
    def __init__(self, master="local[2]"):
        self.dir = None
        self.master = master

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d + "/uuid"


class _Session:
    def __init__(self, value, master="local[2]"):
        self.conf = _Conf(value)
        self.sparkContext = _Ctx(master)


def test_configured_folder_is_used():
    assert shared_dir(_Session("/shared/ckpt/")) == "/shared/ckpt"
    assert scratch_path(_Session("/shared/ckpt"), "x").startswith("/shared/ckpt/argent/x-")


def test_unset_folder_falls_back_once_and_registers_it():
    s = _Session(None)
    first = shared_dir(s)
    assert s.sparkContext.dir == first + "/uuid"
    # Later calls see the registered checkpoint dir (a folder under it).
    assert shared_dir(s).startswith(first)


def test_real_session_has_a_folder(spark):
    assert shared_dir(spark)


def test_unset_folder_on_a_cluster_is_an_error():
    import pytest

    from argent.errors import ETLError

    with pytest.raises(ETLError, match="spark.checkpoint.dir"):
        shared_dir(_Session(None, master="yarn"))
    assert shared_dir(_Session("hdfs:///shared", master="yarn")) == "hdfs:///shared"
