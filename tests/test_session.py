"""Where intermediate tables may go."""

import pytest

from shopfloor.session import checkpoint_dir


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session(spark_master=master))


def test_a_named_folder_is_taken_and_local_masters_get_a_scratch_folder():
    shared = Session(spark_master="yarn")
    shared.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert checkpoint_dir(shared) == "hdfs:///shared"
    local = Session(spark_master="local[4]")
    assert checkpoint_dir(local) == checkpoint_dir(local) == local.conf["spark.checkpoint.dir"]
