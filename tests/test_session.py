from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gaugeflow import session


def _stub(named: str | None, master: str):
    class Context:
        applicationId = "app"
        folder = None

        def setCheckpointDir(self, folder):
            self.folder = f"{folder}/own"

        def getCheckpointDir(self):
            return self.folder

    context = Context()
    context.master = master
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: named), sparkContext=context
    )


def test_the_named_folder_is_used():
    spark = _stub("hdfs://shared/work/", "yarn")
    first, second = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert first.startswith("hdfs://shared/work/gaugeflow/app/x-") and first != second


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(_stub(None, "yarn"))


def test_a_local_run_gets_one_folder_of_its_own():
    spark = _stub(None, "local[2]")
    root = session.shared_root(spark)
    assert root.endswith("/own") and session.shared_root(spark) == root


def test_staged_rows_come_back_in_order_of_columns(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("part"), "id", F.lit("x").alias("s"))
    staged = session.stage(rows, "test", "part")
    assert staged.columns == rows.columns
    assert staged.exceptAll(rows).count() == 0 and staged.count() == 10


def test_tuning_is_applied(spark):
    for name, value in session.RUNTIME.items():
        assert spark.conf.get(name) == value


def test_staged_tables_are_deleted_on_request(spark):
    staged = session.stage(spark.range(10), "kept-for-a-while")
    assert staged.count() == 10 and session.listed(spark, staged.staged_at)
    session.unstage(staged)
    assert session.listed(spark, staged.staged_at) == []
    session.unstage()


def test_staging_leaves_no_shuffles(spark):
    import time

    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    setting = spark.conf.get(session.SHUFFLE_CLEANUP)
    first = held.shuffleStatuses().size()
    for _ in range(3):
        session.stage(spark.range(1000).repartition("id"), "shuffled")
    for _ in range(50):
        if held.shuffleStatuses().size() <= first:
            break
        time.sleep(0.1)
    assert held.shuffleStatuses().size() <= first
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == setting
