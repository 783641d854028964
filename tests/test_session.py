import types
from pathlib import Path

import pytest

from brevita.session import fresh_dir, pin, scratch, shared_dir
from brevita.sources.files import newest_version, versions
from brevita.sources.records import prune_versions, read_version, write_version


def session(master, **conf):
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=get), sparkContext=types.SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session(master))
    assert shared_dir(session(master, spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"


def test_local_mode_may_leave_it_out():
    assert shared_dir(session("local[4]")) == shared_dir(session("local"))


def test_scratch_deletes_what_was_pinned_in_it(spark):
    kept = pin(spark.range(3))
    with scratch(spark):
        gone = pin(spark.range(5))
        path = Path(gone.inputFiles()[0].removeprefix("file://")).parent
        assert gone.count() == 5 and path.exists()
    assert not path.exists() and kept.count() == 3


def test_versions_newest_first_and_pruned(spark):
    path = fresh_dir(spark, "versioned")
    assert newest_version(spark, path) is None
    for n in range(6):
        write_version(spark.range(n + 1), path, n)
    Path(f"{path}/version=6").mkdir()  # not finished
    assert newest_version(spark, path) == 5 and newest_version(spark, path, before=3) == 2
    assert read_version(spark, path, before=5).count() == 5
    prune_versions(spark, path, keep=2)
    assert versions(spark, path) == [4, 5] and not Path(f"{path}/version=0").exists()
