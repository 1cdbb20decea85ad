"""Shared folder: taken from the session; created only when unset."""

from __future__ import annotations

from flowspark.session import shared_dir


class _Conf:
    def __init__(self, value):
        self.values = {"spark.checkpoint.dir": value} if value else {}

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Ctx:
    def __init__(self, ckpt=None):
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Spark:
    def __init__(self, conf_dir=None, ctx_dir=None):
        self.conf = _Conf(conf_dir)
        self.sparkContext = _Ctx(ctx_dir)


def test_uses_cluster_setting():
    s = _Spark("hdfs://nn/shared/ckpt/")
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.ckpt == "hdfs://nn/shared/ckpt/"


def test_keeps_context_checkpoint_dir():
    s = _Spark(None, "s3a://bucket/ckpt")
    assert shared_dir(s) == "s3a://bucket/ckpt"


def test_creates_one_only_when_unset():
    s = _Spark()
    d = shared_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d and s.sparkContext.ckpt == d
    assert shared_dir(s) == d
