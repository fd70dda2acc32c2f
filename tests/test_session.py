"""The checkpoint folder comes from the session; a private temporary folder is
only used in local mode, and a cluster without a setting is an error."""

from __future__ import annotations

import pytest

from quarry.session import checkpoint_dir


class _SparkConf:
    """Like SparkConf: a missing key gives the default."""

    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _RuntimeConf(_SparkConf):
    """Like spark.conf: a missing key without a default raises."""

    def get(self, key, *default):
        if key in self.values:
            return self.values[key]
        if default:
            return default[0]
        raise KeyError(key)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _SparkConf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master, conf)
        self.conf = _RuntimeConf(conf)


def test_configured_folder_is_used():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/shared/ckpt"


def test_local_mode_without_setting_gets_private_folder():
    s = _Session("local[4]", {})
    d = checkpoint_dir(s)
    assert d and "quarry-ckpt-" in d


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn", {}))
