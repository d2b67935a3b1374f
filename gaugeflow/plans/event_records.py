"""A fixed view of `events` as records and messages, for checked queries.

Draws are whole-number arithmetic on the ids, so any engine computes the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S
from gaugeflow.functions import records
from gaugeflow.operators import decode, synth
from gaugeflow.sources.endpoint_config import EndpointConfig
from gaugeflow.sources.messages import bounded_files

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
TOPIC_NAME = "epd01"
PARTITIONS = 4


class EventDraws:
    """Draws from the ids of an event; `normal` is uniform on [-1, 1)."""

    def uniform(self, stream: int) -> str:
        factor, shift = 7919 + 2 * stream, stream * 1299709
        return f"((event_id * {factor} + user_id * 104729 + {shift}) % 10007 / 10007D)"

    def normal(self, stream: int) -> str:
        return f"(2D * {self.uniform(stream)} - 1D)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """`events` as a stream in bounded batches.

    The pattern in the path lets the table be one file or a folder.
    """
    reader = spark.readStream.schema(EVENTS).options(**bounded_files(options))
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def event_records(
    event_rows: DataFrame, config: EndpointConfig, noise: bool = False, coded: bool = False
) -> DataFrame:
    """Event ids with label, categories and sensors; `coded` numbers the levels."""
    ids = event_rows.select("event_id", "user_id", "event_type", "ts")
    simulated = synth.simulate(ids, config, EventDraws(), noise)
    return decode.encode_levels(simulated, config) if coded else simulated


def event_messages(
    event_rows: DataFrame,
    config: EndpointConfig,
    noise: bool = False,
    coded: bool = False,
    topic: Column | None = None,
) -> DataFrame:
    """Events as message envelopes; works on a table and on a stream alike."""
    rows = event_records(event_rows, config, noise, coded)
    topic = F.lit(TOPIC_NAME) if topic is None else topic
    value = records.encode(
        records.wall_time_text(F.col("ts")),
        topic,
        records.group(S.CATEGORIES),
        records.group(S.SENSORS),
    )
    return rows.select(
        records.key_text(F.col("event_id")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        topic.alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / PARTITIONS).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def damage(messages: DataFrame) -> DataFrame:
    """The messages with every way to be bad among them, by offset."""
    kind = F.col("offset") % 32
    text = F.col("value").cast("string")
    damaged = (
        F.when(kind == 0, F.substring(text, 1, 100))
        .when(kind == 1, "")
        .when(kind == 2, None)
        .when(kind == 3, "12")
        .when(kind == 4, "[1]")
        .when(kind == 5, '{"Result":1}')
        .when(kind == 6, F.replace(text, F.lit('"cat0":"'), F.lit('"cat0":"un')))
        .when(kind == 7, F.concat(text, F.lit(" garbage")))
        .when(kind == 8, F.concat(text, text))
        .when(kind == 9, F.replace(text, F.lit('"'), F.lit("'")))
        .when(kind == 10, F.concat(F.lit('{"Result":0,'), F.substring(text, 2, 10_000)))
        .when(kind == 11, F.replace(text, F.lit('"sensor0":'), F.lit('"sensor0":1e999,"other":')))
        .when(kind == 12, F.replace(text, F.lit('"sensor0":'), F.lit('"sensor0":"Infinity","other":')))
        .when(kind == 13, F.regexp_replace(text, '"Result":[01]', '"Result":7'))
        .when(kind == 14, F.regexp_replace(text, '"Result":[01]', '"Result":-1'))
        .otherwise(text)
    )
    return messages.withColumn("value", damaged.cast("binary"))
