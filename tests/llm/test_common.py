import os

import pytest

from symcube.llm import common


class Session:
    """What ``shared_dir`` asks of a session."""

    def __init__(self, master, **settings):
        self.settings = settings
        self.conf, self.sparkContext, self.master = self, self, master

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_a_cluster_needs_a_shared_folder():
    assert common.is_local("local") and common.is_local("local[8]") and not common.is_local("local-cluster[3,2,1000]") and not common.is_local("spark://a:1")
    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Session("spark://a:1"))
    assert common.shared_dir(Session("yarn", **{"spark.checkpoint.dir": "hdfs://a/b/"})).startswith("hdfs://a/b/symcube-")
    here = Session("local[2]")
    first, second = common.shared_dir(here), common.shared_dir(here)
    assert first != second and os.path.dirname(first) == os.path.dirname(second)


def test_workspace(spark):
    work = common.Workspace(spark)
    a, b = work.put(spark.range(3).toDF("x"), "a"), work.put(spark.range(4).toDF("x"), "b")
    assert a.count() == 3 and b.count() == 4
    gone, kept = work.paths["001-a"], work.paths["002-b"]
    work.clear("b")
    assert b.count() == 4 and list(work.paths) == ["002-b"]
    exists = lambda p: (q := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(q)
    assert exists(kept) and not exists(gone)
