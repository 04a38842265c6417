"""Where stages go: the cluster's shared folder, or on one machine a private one."""

import pytest

from tontine.session import ensure_checkpoint_dir
from tontine.sources.sinks import materialize, remove_stages, stage_dir


class _Context:
    def __init__(self, master):
        self.master, self.at = master, None

    def getCheckpointDir(self):
        return self.at

    def setCheckpointDir(self, path):
        self.at = path


class _Session:
    def __init__(self, master, conf):
        self.sparkContext, self.conf = _Context(master), conf


def test_a_cluster_without_a_shared_folder_is_an_error(tmp_path):
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(master, {}))
        assert ensure_checkpoint_dir(_Session(master, {"spark.checkpoint.dir": str(tmp_path)})) == str(tmp_path)
    assert "tontine-ckpt-" in ensure_checkpoint_dir(_Session("local[4]", {}))


def test_stages_are_scoped_to_the_application_and_can_be_removed(spark):
    import os
    df = materialize(spark.range(10), name="t")
    folder = stage_dir(spark).removeprefix("file:")
    assert spark.sparkContext.applicationId in folder and df.count() == 10 and os.path.isdir(folder)
    remove_stages(spark)
    assert not os.path.exists(folder)
    from tontine.plans import actuarial
    assert actuarial.run(spark, "/root/testdata/sf0.001").prem_std.count() == 274
