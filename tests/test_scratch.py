from types import SimpleNamespace

import pytest

from lakeload import scratch


def session(master, **conf):
    settings = SimpleNamespace(get=lambda key, default: conf.get(key, default))
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_the_shared_folder_is_used_where_it_is_named():
    shared = session("spark://m:7077", **{"spark.checkpoint.dir": "hdfs://n/shared/"})
    assert scratch.scratch_root(shared) == "hdfs://n/shared"
    first, second = scratch.new_dir(shared, "a"), scratch.new_dir(shared, "a")
    assert first.startswith("hdfs://n/shared/lakeload-a-") and first != second


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError):
        scratch.scratch_root(session("yarn"))


def test_a_local_session_without_one_gets_one_folder():
    local = session("local[2]")
    assert scratch.scratch_root(local) == scratch.scratch_root(local)
