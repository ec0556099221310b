import types

import pytest

from granary import session


def fake(master, folder=None, named=None):
    context = types.SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: named)
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *_: folder), sparkContext=context)


def test_the_named_folder_is_used():
    assert session.shared_folder(fake("spark://h:7077", "hdfs://a/b/")) == "hdfs://a/b"
    assert session.shared_folder(fake("yarn", None, "hdfs://c")) == "hdfs://c"


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake(master))


def test_a_folder_is_made_up_for_one_process():
    assert session.shared_folder(fake("local[4]")) == session.shared_folder(fake("local[*]"))
