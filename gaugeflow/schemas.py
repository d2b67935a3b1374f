"""Declared schemas and the fixed column order."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and order of the record format.
CATEGORIES = [f"cat{i}" for i in range(8)]
SENSORS = [f"sensor{i}" for i in range(10)]
FEATURES = CATEGORIES + SENSORS
TIME, TOPIC, RESULT = "CurrentTime", "Topic", "Result"
CATEGORY_GROUP, SENSOR_GROUP = "Categories", "Sensors"


def _group(names: list[str], kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name in names])


def record_schema(category_type: T.DataType) -> T.StructType:
    """The record in a message value, with categories of the given type."""
    return T.StructType(
        [
            T.StructField(TIME, T.StringType()),
            T.StructField(TOPIC, T.StringType()),
            T.StructField(RESULT, T.IntegerType()),
            T.StructField(CATEGORY_GROUP, _group(CATEGORIES, category_type)),
            T.StructField(SENSOR_GROUP, _group(SENSORS, T.DoubleType())),
        ]
    )


# Categories as numbers, which the model takes.
CODED_RECORD = record_schema(T.IntegerType())
# Categories as text: level names, or numbers kept as text.
NAMED_RECORD = record_schema(T.StringType())

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

CATEGORY_CONFIG = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("levels", T.ArrayType(T.StringType())),
        T.StructField("oneThresholds", T.ArrayType(T.DoubleType())),
        T.StructField("zeroThresholds", T.ArrayType(T.DoubleType())),
    ]
)

SENSOR_CONFIG = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("simulatorType", T.IntegerType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField("upperLimit", T.DoubleType()),
        T.StructField("lowerLimit", T.DoubleType()),
        T.StructField("upperControl", T.DoubleType()),
        T.StructField("lowerControl", T.DoubleType()),
        T.StructField("oneMean", T.DoubleType()),
        T.StructField("oneStdDev", T.DoubleType()),
        T.StructField("zeroMean", T.DoubleType()),
        T.StructField("zeroStdDev", T.DoubleType()),
    ]
)

ENDPOINT_CONFIG = T.StructType(
    [
        T.StructField("simulator", T.BooleanType()),
        T.StructField("errorRate", T.DoubleType()),
        T.StructField("successRate", T.DoubleType()),
        T.StructField("categories", T.ArrayType(CATEGORY_CONFIG)),
        T.StructField("sensors", T.ArrayType(SENSOR_CONFIG)),
    ]
)
