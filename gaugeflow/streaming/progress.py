"""How far queries have read their topics, as a table: one row per batch, topic and partition.

Sources that count places tell them with every batch as an offset for each topic and partition;
the broker's source and that of topic tables do. Sources without places leave no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from gaugeflow import session

PLACES = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("committed", T.LongType()),
    ]
)


def _offsets(found: object) -> dict[tuple[str, int], int]:
    if not isinstance(found, dict) or not all(isinstance(v, dict) for v in found.values()):
        return {}
    return {(t, int(p)): n for t, places in found.items() for p, n in places.items()}


def places_of(progress: Iterable[StreamingQueryProgress]) -> list[tuple]:
    """Rows of the finished batches of a query."""
    rows = []
    for step in progress:
        for source in json.loads(step.json)["sources"]:
            before, after = _offsets(source.get("startOffset")), _offsets(source.get("endOffset"))
            rows += [(str(step.id), step.batchId, t, p, before.get((t, p), 0), n) for (t, p), n in after.items()]
    return rows


def record(query: StreamingQuery, spark: SparkSession, path: str) -> None:
    """Add the batches that a query has finished since it was last recorded.

    Spark remembers the last hundred batches of a running query, so call this more often.
    A batch is recorded once, in a folder of its own; idle progress adds nothing.
    """
    by_batch: dict[tuple[str, int], list[tuple]] = {}
    for row in places_of(query.recentProgress):
        by_batch.setdefault(row[:2], []).append(row)
    for (name, batch), rows in by_batch.items():
        if f"batch_no={batch}" in session.listed(spark, f"{path}/query_id={name}"):
            continue
        aside = f"{path}/.{name}-{batch}"
        spark.createDataFrame(rows, PLACES).coalesce(1).write.mode("overwrite").parquet(aside)
        session.made(spark, f"{path}/query_id={name}")
        session.renamed(spark, aside, f"{path}/query_id={name}/batch_no={batch}")


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """All recorded rows."""
    if not any(n.startswith("query_id=") for n in session.listed(spark, path)):
        return spark.createDataFrame([], PLACES)
    return spark.read.schema(PLACES).parquet(f"{path}/query_id=*/batch_no=*")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The place that each query has reached in every topic and partition."""
    newest = Window.partitionBy("query", "topic", "partition").orderBy(F.desc("batch"))
    rows = recorded(spark, path).withColumn("_row", F.row_number().over(newest))
    return rows.where("_row = 1").select("query", "batch", "topic", "partition", "committed")


def behind(reached: DataFrame, places: DataFrame) -> DataFrame:
    """Reached places, and how many messages wait there; `places` has `topic, partition, next`.

    Partitions that nobody has read wait whole, for each query that reads the topic.
    """
    readers = reached.select("query", "topic").distinct()
    every = places.join(readers, "topic").select("query", "topic", "partition", "next")
    joined = every.join(reached.drop("batch"), ["query", "topic", "partition"], "left")
    now = F.coalesce("committed", F.lit(0))
    return joined.select("query", "topic", "partition", now.alias("committed"), (F.col("next") - now).alias("behind"))
