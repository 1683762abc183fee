import os
import time

import pytest

from milepost import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Context:
    def __init__(self, master):
        self.master, self.applicationId = master, f"app-{master}"


class FakeSession:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext = Conf(conf), Context(master)


def test_named_folder_wins():
    named = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert session.shared_folder(named) == "hdfs://shared/folder"


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        session.shared_folder(FakeSession("yarn"))


def test_local_fallback_is_kept_for_the_application():
    local = FakeSession("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    assert os.path.isdir(session.shared_folder(local))


def test_staged_rows_survive_and_are_cleared(spark):
    path = session.new_folder(spark, "one")
    assert path.startswith(session.shared_folder(spark))
    kept = session.stage(spark.range(5).withColumnRenamed("id", "n"), "two")
    assert sorted(r.n for r in kept.collect()) == list(range(5))
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert session.remove_folder(spark, folder) and not session.remove_folder(spark, folder)


def test_shuffle_files_go_when_rows_are_staged(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    there = lambda: {str(f.getName()) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()) if "shuffle" in f.getName()}
    before = there()
    rows = session.stage(spark.range(1000).repartition(3, "id").withColumnRenamed("id", "n"), "dealt")
    deadline = time.time() + 20
    while there() - before and time.time() < deadline:
        time.sleep(0.1)  # they are removed in the background
    assert not there() - before
    assert rows.count() == 1000 and spark.conf.get(session.SHUFFLE_CLEANUP, None) is None


def test_staged_rows_last_as_long_as_they_are_used(spark):
    with session.staged(spark.range(5).withColumnRenamed("id", "n"), "short") as rows:
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert sorted(r.n for r in rows.collect()) == list(range(5))
    assert not session.folder_exists(spark, folder)
