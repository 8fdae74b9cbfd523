"""Session helpers."""

from socialcart.session import checkpoint_root, cluster_conf


def test_cluster_conf_sizes_from_the_largest_shuffle():
    c = cluster_conf(100 * 1024 ** 4, 8, 1000)
    assert c["spark.sql.shuffle.partitions"] == "81920"
    assert c["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 ** 2)
    small = cluster_conf(10 ** 9, 8, 4)
    assert small["spark.sql.shuffle.partitions"] == "64"  # at least 2x the cores
    huge = cluster_conf(10 * 1024 ** 5, 8, 1000)
    assert huge["spark.sql.shuffle.partitions"] == "100000"  # clamped


def test_checkpoint_root_is_stable(spark):
    assert checkpoint_root(spark) == checkpoint_root(spark)
