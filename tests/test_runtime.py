import pytest

from worktally import runtime


class _Context:
    def __init__(self, master, conf):
        self.master, self.conf, self.folder = master, conf, None

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder

    def getConf(self):  # noqa: N802
        return self.conf


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext = _Context(master, conf)


def test_checkpoints_go_to_the_shared_folder():
    for master in ("spark://host:7077", "local-cluster[3,2,1024]", "local[4]"):
        session = _Session(master, **{"spark.checkpoint.dir": "file:///shared"})
        runtime.ensure_checkpoint_dir(session)
        assert session.sparkContext.folder == "file:///shared"
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(runtime.NoSharedFolder):
            runtime.ensure_checkpoint_dir(_Session(master))
    one = _Session("local[2]")
    runtime.ensure_checkpoint_dir(one)
    assert one.sparkContext.folder
