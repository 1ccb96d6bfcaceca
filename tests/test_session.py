"""The shared checkpoint folder: never a machine-local one on a cluster."""

import pytest

from revgraph.session import checkpoint_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, ckpt=None):
        self.master = master
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(dict(conf or {}))
        self.sparkContext = _Context(master)


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_cluster_uses_the_configured_folder():
    s = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_root(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_local_session_gets_a_private_folder():
    s = _Session("local[4]")
    root = checkpoint_root(s)
    assert root and s.conf.get("spark.checkpoint.dir") == root


class _SparkConf:
    def __init__(self, keys):
        self.keys = keys

    def contains(self, key):
        return key in self.keys


def test_shuffle_partitions_from_input_size(monkeypatch):
    import revgraph.session as session

    s = _Session("yarn", {"spark.sql.shuffle.partitions": "200"})
    s.sparkContext.getConf = lambda: _SparkConf(set())
    monkeypatch.setattr(session, "input_bytes", lambda spark, paths: 100 * 1024**4)  # 100 TiB
    n = session.size_shuffle_partitions(s, ["hdfs:///dumps"])
    assert n == 100 * 1024**4 // session.BYTES_PER_SHUFFLE_PARTITION
    assert s.conf.get("spark.sql.shuffle.partitions") == str(n)
    # small input: never below the configured default
    monkeypatch.setattr(session, "input_bytes", lambda spark, paths: 10)
    s.conf.set("spark.sql.shuffle.partitions", "200")
    assert session.size_shuffle_partitions(s, ["x"]) == 200
    # a count set by the deployment is kept
    s.sparkContext.getConf = lambda: _SparkConf({"spark.sql.shuffle.partitions"})
    s.conf.set("spark.sql.shuffle.partitions", "5000")
    assert session.size_shuffle_partitions(s, ["x"]) == 5000
