import os

import pytest

from parcelmill import session
from parcelmill.session import drop_staged, shared_folder, spread, stage, staging


def test_stage_uses_the_shared_folder_and_is_dropped(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(f.startswith(f"file://{folder}/staged/") or folder in f for f in staged.inputFiles())
    drop_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(staged.inputFiles()[0]).count()


def test_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_spread_leaves_large_inputs_alone(spark):
    many = spark.range(0, 100, 1, 32)
    assert spread(many, "id") is many
    assert spread(many.coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_spread_never_shuffles_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(session, "SPREAD_BYTES", 10)
    few = spark.range(0, 100, 1, 1)
    assert spread(few, "id") is few


def test_staging_leaves_nothing_behind(spark):
    with staging(spark):
        path = stage(spark.range(5), "short").inputFiles()[0]
        assert os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))


def test_only_one_process_counts_as_local():
    assert session.LOCAL.match("local") and session.LOCAL.match("local[4]")
    assert not session.LOCAL.match("local-cluster[2,1,1024]")
