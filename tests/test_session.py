import os

from retail_pulse.session import ensure_checkpoint_dir, shared_dir


def test_work_folders_live_under_the_sessions_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert root  # set by the environment or, in tests only, by ensure_checkpoint_dir
    a, b = shared_dir(spark, "probe"), shared_dir(spark, "probe")
    assert a != b  # a fresh folder per call
    assert os.path.realpath(a).startswith(os.path.realpath(root.replace("file:", "")))


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before
