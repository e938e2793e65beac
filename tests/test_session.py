"""Session helpers: sizing and the shared checkpoint folder."""

from sensorflow.session import checkpoint_root, ensure_checkpoint_dir, scratch_path, sizing_conf

TB = 1024 ** 4


def test_sizing_at_100_tb():
    conf = sizing_conf(100 * TB)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 4096)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 * 1024
    small = sizing_conf(10 * 1024 * 1024)
    assert small["spark.sql.shuffle.partitions"] == "200"
    mid = sizing_conf(TB)
    assert int(mid["spark.sql.shuffle.partitions"]) == 4096


def test_checkpoint_folder_from_session(spark):
    root = checkpoint_root(spark)
    assert root and ensure_checkpoint_dir(spark) == root
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(root.rstrip("/"))


def test_scratch_folder_needs_a_shared_root_on_a_cluster(monkeypatch):
    import pytest
    from sensorflow import session

    class Cluster:
        conf = {"spark.master": "yarn"}

    monkeypatch.setattr(session, "checkpoint_root", lambda _: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_local_masters():
    from sensorflow.session import _is_local

    assert [m for m in ("local", "local[4]", "local[*]", "local-cluster[3,2,1000]", "yarn", "") if _is_local(m)] == [
        "local", "local[4]", "local[*]"]
