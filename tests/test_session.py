"""Where intermediate tables may go."""

import pytest

from clickspark import session


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, d):
        self.folder = d


class FakeSession:
    def __init__(self, master, conf=None):
        self.sparkContext = FakeContext(master)
        self.settings = conf or {}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(FakeSession(master), "x")
        given = FakeSession(master, {"spark.checkpoint.dir": "hdfs://shared/ck"})
        assert session.shared_dir(given, "x").startswith("hdfs://shared/ck/x/")


def test_a_local_session_gets_a_folder():
    assert "clickspark-ckpt-" in session.shared_dir(FakeSession("local[2]"), "x")
