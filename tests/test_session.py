"""Shared working folders come from the session's checkpoint settings."""

from regioncast.session import ensure_checkpoint_dir, shared_dir


def test_shared_dir_lives_under_the_configured_checkpoint_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured
    a, b = shared_dir(spark, "scratch"), shared_dir(spark, "scratch")
    base = configured.rstrip("/")
    assert a.startswith(base + "/regioncast/scratch-") and b.startswith(base + "/regioncast/scratch-")
    assert a != b  # a fresh folder per call


def test_checkpoint_folder_is_kept_when_set(spark):
    before = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == before
