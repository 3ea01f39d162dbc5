"""The shared checkpoint folder: read from the session, never overridden."""

from prodlink.session import checkpoint_root, scratch_path


def test_checkpoint_root_uses_the_session_setting(spark):
    preset = spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if preset:
        assert root == preset
    assert spark.sparkContext.getCheckpointDir()
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(root.rstrip("/") + "/scratch/")
