from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions.draws import HashedDraws
from gaugeflow.operators import decode, synth
from gaugeflow.plans import jobs
from gaugeflow.sources.endpoint_config import packaged_config
from gaugeflow.sources.messages import Subscription, message_scan
from gaugeflow.streaming import runs, sinks

N = 60_000


@pytest.fixture(scope="module")
def made(spark, config):
    rows = spark.range(0, N, 1, 6)
    return synth.simulate(rows, config, HashedDraws("id")).persist()


def _near(share: float, wanted: float, n: int) -> bool:
    return abs(share - wanted) < 5 * (wanted * (1 - wanted) / n) ** 0.5 + 1e-9


def test_share_of_ones(made, config):
    ones = made.where(F.col(S.RESULT) == 1).count()
    assert _near(ones / N, config.success_rate, N)


def test_share_of_levels(made, config):
    for category in config.categories:
        counted = made.groupBy(S.RESULT, category.name).count().collect()
        for label, thresholds in ((1, category.one_thresholds), (0, category.zero_thresholds)):
            counts = {r[category.name]: r["count"] for r in counted if r[S.RESULT] == label}
            n, below = sum(counts.values()), 0.0
            for level, threshold in zip(category.levels, thresholds):
                drawn = (threshold - below) * (1 - config.error_rate)
                wanted = drawn + config.error_rate / len(category.levels)
                assert _near(counts.get(level, 0) / n, wanted, n), (category.name, label, level)
                below = threshold


def test_moments_of_readings(made, config):
    for sensor in config.sensors:
        for label, mean, std in (
            (1, sensor.zero_mean, sensor.zero_std), (0, sensor.one_mean, sensor.one_std),
        ):
            seen = (
                made.where(F.col(S.RESULT) == label)
                .agg(F.avg(sensor.name).alias("m"), F.stddev_samp(sensor.name).alias("s"))
                .first()
            )
            # Cutting toward zero moves a mean by less than half a unit.
            assert abs(seen.m - mean * sensor.scale) < 0.55 + 0.02 * sensor.scale * std
            assert abs(seen.s - std * sensor.scale) < 0.6


def test_readings_are_whole(made):
    off = [F.count_if(F.col(name) != F.floor(name)).alias(name) for name in S.SENSORS]
    assert set(made.agg(*off).first()) == {0}


def test_messages_can_be_decoded(spark, config):
    generated = synth.generate(spark, 500, config, "epd01", partitions=3)
    assert generated.columns == ["topic", "key", "value"]
    assert {r.key for r in generated.collect()} == {str(i) for i in range(500)}
    as_envelopes = generated.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        F.col("key").cast("bigint").alias("offset"),
    )
    decoded = decode.decode_messages(as_envelopes, config)
    assert {r.status for r in decoded.collect()} == {"ok"}


def test_records_do_not_depend_on_the_layout(spark, config):
    columns = [S.RESULT, *S.CATEGORIES, *S.SENSORS]
    draws = HashedDraws("id", seed=3)
    few = synth.simulate(spark.range(0, 2000, 1, 2), config, draws).select("id", *columns)
    many = synth.simulate(spark.range(0, 2000, 1, 9), config, draws).select("id", *columns)
    assert few.exceptAll(many).count() == 0
    other = synth.simulate(spark.range(2000), config, HashedDraws("id", seed=4))
    assert few.select(*columns).exceptAll(other.select(*columns)).count() > 1500


def test_a_sensor_of_no_family_is_left_out(spark):
    families = packaged_config("sensor_families.json")
    rows = synth.generate(spark, 5, families, "t").collect()
    for row in rows:
        names = set(json.loads(row.value)["Sensors"])
        assert names == set(S.SENSORS) - {"sensor4"}


def test_generation_needs_no_shuffle_and_no_python(spark, config, plan_of):
    plan = plan_of(synth.generate(spark, 10, config, "t"))
    for operator in ("Exchange", "Python", "Sort"):
        assert operator not in plan


def test_generated_stream(spark, config, tmp_path):
    stream = synth.generate_stream(spark, config, "t", rows_per_second=20)
    writer = sinks.to_table(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    runs.run_for(writer, 6)
    rows = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()
    assert len({r.key for r in rows}) == len(rows) > 0


def test_published_messages_are_routed_by_topic(spark, config, tmp_path):
    path = str(tmp_path / "published")
    both = synth.generate(spark, 20, config, "a", partitions=2).unionByName(
        synth.generate(spark, 30, config, "b", partitions=3)
    )
    jobs.publish(both, "parquet", path)
    rows = message_scan(spark, Subscription(("b",)), "parquet", path).collect()
    assert len(rows) == 30
    assert len({(r.partition, r.offset) for r in rows}) == 30
    assert {r.key.decode() for r in rows} == {str(i) for i in range(30)}
