import pytest

from vantage.session import checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master)


def test_checkpoint_dir_is_read_from_the_session():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_local_session_without_setting_gets_a_scratch_folder():
    s = _Session("local[4]")
    path = checkpoint_dir(s)
    assert path and s.conf.get("spark.checkpoint.dir") == path


def test_cluster_session_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("spark://master:7077"))
