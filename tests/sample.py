"""Hand-written records and messages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from gaugeflow import schemas as S

LEVELS = {
    "cat0": "sound", "cat1": "mild", "cat2": "stopped", "cat3": "red",
    "cat4": "present", "cat5": "west", "cat6": "automatic", "cat7": "medium",
}
CODES = [0, 2, 0, 0, 1, 3, 2, 1]


def record(**changes) -> dict:
    """A good record; keyword arguments replace members of either group or the top."""
    made = {
        "CurrentTime": "2024-01-01 00:00:00",
        "Topic": "epd01",
        "Result": 1,
        "Categories": dict(LEVELS),
        "Sensors": {name: float(i) for i, name in enumerate(S.SENSORS)},
    }
    for name, value in changes.items():
        home = next((made[g] for g in ("Categories", "Sensors") if name in made[g]), made)
        home[name] = value
    return made


def text(**changes) -> str:
    return json.dumps(record(**changes))


def messages(
    spark: SparkSession, values: list[str | None], topic: str = "epd01", first_offset: int = 0
) -> DataFrame:
    """Envelopes in one Spark partition, offsets in the order of the list."""
    rows = [
        (str(i).encode(), None if v is None else v.encode(), topic, 0, first_offset + i, None, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, S.ENVELOPE).coalesce(1)
