import os

import pytest

from cohortlab import session


class FakeContext:
    def __init__(self, master, conf=None, own=None):
        self.master, self.conf, self.own = master, conf or {}, own

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.own

    def setCheckpointDir(self, path):
        self.own = f"{path}/app"


class FakeSession:
    def __init__(self, *args, **kw):
        self.sparkContext = FakeContext(*args, **kw)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_cluster_without_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(FakeSession(master))


def test_folder_of_the_session_is_used():
    named = FakeSession("yarn", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.checkpoint_dir(named) == "hdfs:///shared" and named.sparkContext.own == "hdfs:///shared/app"
    assert session.scratch_path(named, "t").startswith("hdfs:///shared/t-")
    session._SCRATCH.pop()
    own = FakeSession("yarn", own="hdfs:///set/app")
    assert session.checkpoint_dir(own) == "hdfs:///set/app"


def test_local_folder_is_private_and_never_empty():
    for master in ("local", "local[4]"):
        path = session.checkpoint_dir(FakeSession(master))
        assert os.path.isdir(path) and path != "/"


def test_scratch_tables_are_deleted(spark):
    keep = session._SCRATCH[:]
    session._SCRATCH.clear()
    try:
        path = session.scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path)
        assert session.clear_scratch(spark) == 1 and not os.path.exists(path) and session.clear_scratch(spark) == 0
    finally:
        session._SCRATCH.extend(keep)
