"""Labelled records of any number, computed column by column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions import levels, readings, records, sql
from gaugeflow.functions.draws import Draws, HashedDraws
from gaugeflow.sources.endpoint_config import Category, EndpointConfig, Sensor


class _Streams:
    """Stream numbers: the label, then categories, sensors, and category noise."""

    def __init__(self, config: EndpointConfig):
        n, m = len(config.categories), len(config.sensors)
        self.label = 0
        self.category = range(1, 1 + n)
        self.sensor = range(1 + n, 1 + n + m)
        self.chance = range(1 + n + m, 1 + 2 * n + m)
        self.pick = range(1 + 2 * n + m, 1 + 3 * n + m)


def simulate(
    rows: DataFrame, config: EndpointConfig, draws: Draws, noise: bool = True
) -> DataFrame:
    """Add a label, every configured category and every configured sensor.

    The work is laid out in three projections. Catalyst keeps them apart, since
    each uses columns of the one before more than once, so no draw is computed
    twice and no generated method grows beyond what the JVM compiles.
    """
    kept = [sql.name(column) for column in rows.columns]
    drawn = rows.selectExpr(*kept, *_draws(config, draws, noise))
    label = readings.drawn_label("_label", config.success_rate)
    labelled = drawn.selectExpr("*", sql.named(label, S.RESULT))
    measured = labelled.selectExpr(
        *[sql.name(c) for c in labelled.columns if not c.startswith("_reading")],
        *[_thousandths(s, i) for i, s in enumerate(config.sensors)],
    )
    return measured.selectExpr(
        *kept,
        S.RESULT,
        *[_category(c, i, noise) for i, c in enumerate(config.categories)],
        *[
            sql.named(readings.whole_units(f"_thousandths{i}"), s.name)
            for i, s in enumerate(config.sensors)
        ],
    )


def _draws(config: EndpointConfig, draws: Draws, noise: bool) -> list[str]:
    streams = _Streams(config)
    drawn = {"_label": draws.uniform(streams.label)}
    for i, stream in enumerate(streams.category):
        drawn[f"_level{i}"] = draws.uniform(stream)
    for i, (sensor, stream) in enumerate(zip(config.sensors, streams.sensor)):
        draw = draws.uniform if sensor.kind == readings.UNIFORM else draws.normal
        drawn[f"_reading{i}"] = draw(stream)
    if noise:
        each = zip(config.categories, streams.chance, streams.pick)
        for i, (category, chance, pick) in enumerate(each):
            drawn[f"_replaced{i}"] = levels.replacement(
                draws.uniform(chance),
                draws.uniform(pick),
                config.error_rate,
                len(category.levels),
            )
    return [sql.named(expression, column) for column, expression in drawn.items()]


def _thousandths(sensor: Sensor, i: int) -> str:
    draw = f"_reading{i}"
    raw = readings.raw_reading(sensor, S.RESULT, normal=draw, uniform=draw)
    return sql.named(readings.thousandths(raw, sensor.scale), f"_thousandths{i}")


def _category(category: Category, i: int, noise: bool) -> str:
    level = levels.labelled_level(f"_level{i}", S.RESULT, category)
    if noise:
        level = levels.noisy_level(level, f"_replaced{i}", category.levels)
    return sql.named(level, category.name)


def to_messages(
    simulated: DataFrame, config: EndpointConfig, key: Column, time: Column, topic: Column
) -> DataFrame:
    """Simulated columns as messages `topic, key, value`."""
    value = records.encode(
        time,
        topic,
        records.group([c.name for c in config.categories]),
        records.group([s.name for s in config.sensors]),
    )
    return simulated.select(
        topic.alias("topic"), records.key_text(key).alias("key"), value.alias("value")
    )


def generate(
    spark: SparkSession,
    n: int,
    config: EndpointConfig,
    topic: str,
    seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    """`n` messages with keys from 0, each stamped with the time of the query."""
    ids = spark.range(0, n, 1, partitions)
    simulated = simulate(ids, config, HashedDraws("id", seed=seed))
    now = records.time_text(F.current_timestamp())
    return to_messages(simulated, config, F.col("id"), now, F.lit(topic))


def generate_stream(
    spark: SparkSession, config: EndpointConfig, topic: str, rows_per_second: int, seed: int = 42
) -> DataFrame:
    """The same as an endless stream; the key is the row number of the stream."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    simulated = simulate(ticks, config, HashedDraws("value", seed=seed))
    return to_messages(
        simulated, config, F.col("value"), records.time_text(F.col("timestamp")), F.lit(topic)
    )
