import pytest

from verdigris.sources import storage


def test_the_named_folder_comes_first():
    assert storage.shared_folder("spark://host:7077", "hdfs://store/shared", "file:/w") == "hdfs://store/shared"
    assert storage.shared_folder("yarn", "/mnt/shared", "/w") == "/mnt/shared"


def test_a_shared_warehouse_stands_in():
    assert storage.shared_folder("yarn", None, "hdfs://store/w/") == "hdfs://store/w/_scratch"
    assert storage.shared_folder("local[8]", None, "file:/w") == "file:/w/_scratch"
    assert storage.shared_folder("local", None, "/w") == "/w/_scratch"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,3000]"])
@pytest.mark.parametrize("warehouse", ["file:/w", "file:///w", "/w", "spark-warehouse"])
def test_a_local_warehouse_on_a_cluster_is_refused(master, warehouse):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(master, None, warehouse)


def test_paths_are_fresh(spark):
    assert storage.scratch_path(spark, "a") != storage.scratch_path(spark, "a")
