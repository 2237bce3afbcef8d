"""Shared folder and shuffle sizing."""

import pytest

from cohortlens import session as S
from tests.conftest import SF001, SF01


class _Context:
    def __init__(self, master):
        self.master = master
        self._jsc = self

    def getConf(self):
        return self

    def get(self, key, default=None):
        return default

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isDefined(self):
        return False


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            S.checkpoint_dir(type("Session", (), {"sparkContext": _Context(master)}))


def test_partitions_follow_each_input(spark, monkeypatch):
    monkeypatch.setattr(S, "_TARGET_PARTITION_BYTES", 4096)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        small = S.size_shuffle_partitions(spark, SF001)
        large = S.size_shuffle_partitions(spark, SF01)
        assert small < large == int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert S.size_shuffle_partitions(spark, SF001) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
