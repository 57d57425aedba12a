from types import SimpleNamespace

import pytest

from marketbars.storage import new_folder, shared_dir, stage


class Context:
    """As much of a context as choosing the folder needs."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None, folder=None):
    conf = SimpleNamespace(get=lambda name, default: named or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master, folder))


def test_the_named_folder_is_used():
    assert shared_dir(session("yarn", named="hdfs:/scratch")) == "hdfs:/scratch"
    assert shared_dir(session("yarn", folder="hdfs:/set")) == "hdfs:/set"


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))


def test_a_local_session_gets_one_folder():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert new_folder(local) != new_folder(local)


def test_copies_lie_in_the_session_folder(spark):
    root = shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    (file,) = stage(spark.range(1).coalesce(1)).inputFiles()
    assert root in file


def test_nothing_is_left_of_a_scratch(spark):
    import os

    from marketbars.plans.registry import QUERIES
    from marketbars.storage import scratch, shared_dir

    def left():
        folders = set(os.listdir(f"{shared_dir(spark)}/marketbars"))
        return folders, {d.name for d in spark.catalog.listDatabases()}

    stage(spark.range(1))
    before = left()
    with scratch(spark):
        assert QUERIES["table_insert"](spark, "/root/testdata/sf0.001").count() > 0
        assert left() != before
    assert left() == before
