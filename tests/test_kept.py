"""Where intermediate tables may go."""

import pytest

from ratelattice.sources import kept


class Session:
    """A session without a shared folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, name, default=None):
        return default

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        kept.shared_folder(Session(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_fallback(master):
    assert kept.shared_folder(Session(master))


def test_a_scope_removes_what_was_kept_inside(spark):
    import os

    outside = kept.keep(spark.range(5), "a")
    with kept.scope(spark):
        inside = kept.keep(spark.range(7), "b")
        folder = inside.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder) and inside.count() == 7
    assert not os.path.exists(folder) and outside.count() == 5
