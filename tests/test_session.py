"""Scratch locations come from the session's checkpoint folder."""

from __future__ import annotations

import pytest

from panelkit import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, ckpt=None, master="local[2]"):
        self.ckpt = ckpt
        self.master = master

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d + "/uuid-sub"


class _Session:
    def __init__(self, conf_value=None, ckpt=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(ckpt)


def test_configured_folder_is_used():
    s = _Session("hdfs://shared/ckpt/")
    assert session.ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs://shared/ckpt/panelkit-scratch/x-")


def test_unset_folder_gets_a_local_one_registered():
    s = _Session(None, None)
    d = session.ensure_checkpoint_dir(s)
    assert d.endswith("/uuid-sub") and s.sparkContext.getCheckpointDir() == d
    assert session.ensure_checkpoint_dir(s) == d


def test_real_session_uses_its_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert session.scratch_path(spark, "y").startswith(configured.rstrip("/"))


def test_cluster_settings_scale_with_shuffle_size():
    small = session.cluster_settings(10 << 30, total_cores=8000)
    big = session.cluster_settings(30 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16000          # waves of cores
    assert int(big["spark.sql.shuffle.partitions"]) == (30 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_scope_removes_what_was_written(spark):
    with session.scratch_scope(spark):
        df = session.materialize(spark.range(5), "inside")
        path = df.inputFiles()[0]
        kept = session.materialize(spark.range(3), "kept", keep=True)
        assert df.count() == 5
    import os

    assert not os.path.exists(path.replace("file://", ""))
    assert kept.count() == 3


def test_no_machine_local_folder_on_a_cluster():
    s = _Session(None, None)
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(s)
