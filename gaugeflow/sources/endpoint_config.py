"""Endpoint configuration: read it, check it, and view it as tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from importlib import resources
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import ENDPOINT_CONFIG


@dataclass(frozen=True)
class Category:
    name: str
    levels: tuple[str, ...]
    one_thresholds: tuple[float, ...]
    zero_thresholds: tuple[float, ...]


@dataclass(frozen=True)
class Sensor:
    name: str
    kind: int
    scale: float
    one_mean: float
    one_std: float
    zero_mean: float
    zero_std: float


@dataclass(frozen=True)
class EndpointConfig:
    error_rate: float
    success_rate: float
    categories: tuple[Category, ...]
    sensors: tuple[Sensor, ...]

    def levels_of(self, name: str) -> tuple[str, ...]:
        return next(c.levels for c in self.categories if c.name == name)


class ConfigError(ValueError):
    """The endpoint configuration cannot be used."""


def bind(document: Mapping[str, Any]) -> EndpointConfig:
    """Turn a configuration document into checked values."""
    config = EndpointConfig(
        error_rate=document["errorRate"],
        success_rate=document["successRate"],
        categories=tuple(
            Category(
                c["name"],
                tuple(c["levels"]),
                tuple(c["oneThresholds"]),
                tuple(c["zeroThresholds"]),
            )
            for c in document["categories"]
        ),
        sensors=tuple(
            Sensor(
                s["name"],
                s["simulatorType"],
                s["scale"],
                s["oneMean"],
                s["oneStdDev"],
                s["zeroMean"],
                s["zeroStdDev"],
            )
            for s in document["sensors"]
        ),
    )
    problems = check(config)
    if problems:
        raise ConfigError("; ".join(problems))
    return config


def check(config: EndpointConfig) -> list[str]:
    """Say what is wrong with a configuration; an empty list means nothing."""
    problems = []
    for label, rate in (("errorRate", config.error_rate), ("successRate", config.success_rate)):
        if not 0 <= rate <= 1:
            problems.append(f"{label} is outside 0..1")
    names = [x.name for x in (*config.categories, *config.sensors)]
    if len(set(names)) < len(names):
        problems.append("a name is used twice")
    for category in config.categories:
        if len(set(category.levels)) < len(category.levels):
            problems.append(f"{category.name}: a level is listed twice")
        for side, thresholds in (
            ("oneThresholds", category.one_thresholds),
            ("zeroThresholds", category.zero_thresholds),
        ):
            problems += [
                f"{category.name}.{side}: {problem}"
                for problem in _threshold_problems(thresholds, len(category.levels))
            ]
    return problems


def _threshold_problems(thresholds: Sequence[float], n_levels: int) -> list[str]:
    problems = []
    if len(thresholds) != n_levels:
        problems.append("one threshold per level is needed")
    if list(thresholds) != sorted(thresholds):
        problems.append("thresholds must not fall")
    if not thresholds or thresholds[-1] != 1.0:
        problems.append("the last threshold must be 1")
    return problems


def packaged_text(name: str = "endpoint.json") -> str:
    """Text of a configuration that ships with the package."""
    return resources.files("gaugeflow").joinpath("config", name).read_text()


def packaged_config(name: str = "endpoint.json") -> EndpointConfig:
    return bind(json.loads(packaged_text(name)))


def config_from_text(spark: SparkSession, text: str) -> DataFrame:
    """A configuration text as a one-row table."""
    document = F.from_json(F.lit(text), ENDPOINT_CONFIG)
    return spark.range(1).select(document.alias("config")).select("config.*")


def scan_config(spark: SparkSession, path: str) -> DataFrame:
    """A configuration file as a one-row table; the whole file is one document."""
    return spark.read.schema(ENDPOINT_CONFIG).option("multiLine", True).json(path)


def read_config(spark: SparkSession, path: str) -> EndpointConfig:
    """A configuration file as checked values; brings one row to the driver."""
    rows = scan_config(spark, path).take(2)
    if len(rows) != 1:
        raise ConfigError(f"{path} must hold exactly one document")
    return bind(rows[0].asDict(recursive=True))


def level_table(config: DataFrame) -> DataFrame:
    """One row per category level: category, level number, level, thresholds."""
    category = config.select(F.explode("categories").alias("c"))
    levels = category.select(
        "c", F.posexplode("c.levels").alias("level_no", "level")
    )
    return levels.select(
        F.col("c.name").alias("category"),
        "level_no",
        "level",
        F.get("c.oneThresholds", "level_no").alias("one_threshold"),
        F.get("c.zeroThresholds", "level_no").alias("zero_threshold"),
    )


def sensor_table(config: DataFrame) -> DataFrame:
    """One row per sensor, with its position in the configuration."""
    sensors = config.select(F.posexplode("sensors").alias("sensor_no", "s"))
    return sensors.select("sensor_no", "s.*")
