"""Batches that appear whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import session
from gaugeflow.streaming import manifests, runs

IDS = T.StructType([T.StructField("id", T.LongType())])


@pytest.fixture
def table(tmp_path):
    return manifests.WholeBatches(str(tmp_path / "table"))


def _ids(spark, table, branch):
    return sorted((r.batch, r.id) for r in table.read(spark, branch, IDS).collect())


def test_branches_appear_together(spark, table):
    assert _ids(spark, table, "a") == [] and table.manifests(spark).count() == 0
    table.write({"a": spark.range(3), "b": spark.range(2)}, 0)
    table.write({"a": spark.range(5, 6), "b": spark.range(0)}, 1)
    assert _ids(spark, table, "a") == [(0, 0), (0, 1), (0, 2), (1, 5)]
    assert _ids(spark, table, "b") == [(0, 0), (0, 1)]
    assert _ids(spark, table, "none") == []


def test_a_batch_is_written_once(spark, table):
    table.write({"a": spark.range(3)}, 0)
    table.write({"a": spark.range(9)}, 0)
    assert _ids(spark, table, "a") == [(0, 0), (0, 1), (0, 2)]


@pytest.mark.parametrize("where", ["between", "within", "manifest"])
def test_a_failed_batch_is_not_there(spark, table, monkeypatch, where):
    table.write({"a": spark.range(1), "b": spark.range(1)}, 0)
    bad = spark.range(0, 8, 1, 4).select(
        F.when(F.col("id") == 7, F.raise_error(F.lit("bad"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    branches = {
        "between": {"a": spark.range(4), "b": bad}, "within": {"a": bad, "b": spark.range(4)},
        "manifest": {"a": spark.range(4), "b": spark.range(4)},
    }[where]
    with monkeypatch.context() as broken:
        if where == "manifest":
            broken.setattr(session, "renamed", lambda *a: (_ for _ in ()).throw(OSError("bad")))
        with pytest.raises(Exception, match="bad"):
            table.write(branches, 1)
    assert _ids(spark, table, "a") == _ids(spark, table, "b") == [(0, 0)]
    table.write({"a": spark.range(2), "b": spark.range(2)}, 1)
    assert _ids(spark, table, "a") == _ids(spark, table, "b") == [(0, 0), (1, 0), (1, 1)]
    left = table.vacuum(spark)
    assert left == {"between": 2, "within": 1, "manifest": 2}[where] and table.vacuum(spark) == 0
    assert _ids(spark, table, "b") == [(0, 0), (1, 0), (1, 1)]


def test_manifests_name_the_files(spark, tmp_path):
    table = manifests.WholeBatches(str(tmp_path / "t"), partition_by=("odd",))
    rows = spark.range(6).withColumn("odd", F.col("id") % 2)
    table.write({"a": rows}, 4)
    row = table.manifests(spark).first()
    assert (row.branch, row.batch) == ("a", 4)
    assert {f.split("/")[-2] for f in row.files} == {"odd=0", "odd=1"}
    read = table.read(spark, "a", T.StructType([*IDS, T.StructField("odd", T.LongType())]))
    assert sorted((r.id, r.odd, r.batch) for r in read.collect()) == [(i, i % 2, 4) for i in range(6)]


def test_a_stream_that_failed_between_its_branches(spark, table, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    spark.range(4).write.parquet(source)
    stream = spark.readStream.schema(IDS).parquet(source)

    def broken(batch):
        return batch.select(F.raise_error(F.lit("bad")).cast("long").alias("id"))

    shapes = {"a": lambda batch: batch, "b": broken}
    with pytest.raises(Exception, match="bad"):
        runs.run_available(manifests.fan_out_whole(stream, shapes, table, checkpoint))
    assert _ids(spark, table, "a") == []
    shapes["b"] = lambda batch: batch.select((F.col("id") * 10).alias("id"))
    runs.run_available(manifests.fan_out_whole(stream, shapes, table, checkpoint))
    assert _ids(spark, table, "a") == [(0, i) for i in range(4)]
    assert _ids(spark, table, "b") == [(0, 10 * i) for i in range(4)]
