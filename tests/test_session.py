from types import SimpleNamespace

import pytest

from archive_spark.session import scratch_path


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder, set=pytest.fail)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_a_shared_folder_is_used_on_any_master():
    assert scratch_path(session("yarn", "s3a://b/tmp/"), "x").startswith("s3a://b/tmp/x-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError):
        scratch_path(session(master), "x")


def test_one_machine_uses_one_temporary_folder():
    first, second = (scratch_path(session("local[4]"), n) for n in "ab")
    assert first.rpartition("/")[0] == second.rpartition("/")[0] and first != second
