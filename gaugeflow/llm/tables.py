"""Tables, folds and row keys that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def text_key(text: str = "text") -> Column:
    """With doc_id this names a row; rows equal in both are interchangeable."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def bounded_sample(rows: DataFrame, by: str, most: int, key: str = "doc_id") -> DataFrame:
    """At most `most` rows of each class, the same ones whatever the partitioning.

    Only about twice as many rows as are kept are ordered within a class.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("_of_class"))
    share = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    # One row per class that a model can tell apart. Else all rows would be dealt by class.
    near = rows.join(F.broadcast(counts), by).where(share <= F.lit(2.0 * most) / F.col("_of_class"))
    order = Window.partitionBy(by).orderBy(F.xxhash64(F.col(key), F.lit(7)), key)
    return near.withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= most).select(*rows.columns)


#: A group is heavy if it holds more than one in so many rows; no more than so many groups are.
HEAVY_SHARE = 1000


def with_group(rows: DataFrame, groups: DataFrame, by: str, n: str) -> DataFrame:
    """Rows joined with what is known of their group; `n` is the number of rows of each.

    Heavy groups, at most HEAVY_SHARE of them, are broadcast, so their rows stay where they are.
    """
    total = groups.agg(F.sum(n)).first()[0] or 0
    heavy = F.broadcast(groups.where(F.col(n) * HEAVY_SHARE > total))
    light = rows.join(heavy.select(by), by, "left_anti").join(groups, by)
    return rows.join(heavy, by).unionByName(light)


def give_back() -> None:
    """Return memory that the task has freed to the system; the worker lives on."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def per_batch(
    rows: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a function to every Arrow batch of the rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            if made is not None and made.num_rows:
                yield made
            give_back()

    return rows.mapInArrow(each, schema)


def tuned(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Keep Arrow batches small, since single texts can be very long."""

    @functools.wraps(query)
    def run(spark: SparkSession, *given) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        return query(spark, *given)

    return run
