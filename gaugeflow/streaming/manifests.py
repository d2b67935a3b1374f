"""Tables whose batches appear whole: all branches of a batch at once, or none of it.

    <path>/data/<branch>/batch=<n>/attempt=<id>/...   one attempt to write one branch
    <path>/_manifests/batch=<n>/...                   names the attempt of every branch

A batch is there once its manifest is, which one rename brings about. Readers take the attempts
that manifests name, so an attempt that failed half-way, between two branches or within one,
is never read, and a batch that comes again is written once. Nothing that is read is replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from gaugeflow import session

MANIFEST = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("files", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class WholeBatches:
    """One writer at a time; its batches have numbers of their own."""

    path: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ()

    def _manifest(self, batch_id: int) -> str:
        return f"{self.path}/_manifests/batch={batch_id}"

    def _attempt(self, branch: str, batch_id: int, attempt: str) -> str:
        return f"{self.path}/data/{branch}/batch={batch_id}/attempt={attempt}"

    def committed(self, spark: SparkSession, batch_id: int) -> bool:
        return f"batch={batch_id}" in session.listed(spark, f"{self.path}/_manifests")

    def write(self, branches: Mapping[str, DataFrame], batch_id: int) -> None:
        """Write every branch aside, then make the batch appear."""
        spark = next(iter(branches.values())).sparkSession
        if self.committed(spark, batch_id):
            return
        named = []
        for branch, rows in branches.items():
            attempt = uuid.uuid4().hex
            folder = self._attempt(branch, batch_id, attempt)
            rows.write.format(self.fmt).partitionBy(*self.partition_by).save(folder)
            files = session.listed_files(spark, folder)
            named.append((branch, attempt, [f for f in files if not f.rsplit("/", 1)[-1].startswith(("_", "."))]))
        aside = f"{self.path}/_manifests/.{uuid.uuid4().hex}"
        spark.createDataFrame(named, MANIFEST).coalesce(1).write.parquet(aside)
        session.renamed(spark, aside, self._manifest(batch_id))

    def manifests(self, spark: SparkSession) -> DataFrame:
        """Every committed batch: its branches, their attempts and files."""
        whole = T.StructType([*MANIFEST.fields, T.StructField("batch", T.LongType())])
        if not any(n.startswith("batch=") for n in session.listed(spark, f"{self.path}/_manifests")):
            return spark.createDataFrame([], whole)
        folder = f"{self.path}/_manifests"
        return spark.read.schema(whole).option("basePath", folder).parquet(f"{folder}/batch=*")

    def read(self, spark: SparkSession, branch: str, schema: T.StructType) -> DataFrame:
        """The committed batches of a branch, with the number of each as `batch`."""
        whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        # One row for each batch.
        rows = self.manifests(spark).where(F.col("branch") == branch).select("batch", "attempt", "files").collect()
        folders = [self._attempt(branch, r.batch, r.attempt) for r in rows if r.files]
        if not folders:
            return spark.createDataFrame([], whole)
        reader = spark.read.format(self.fmt).schema(whole).option("basePath", f"{self.path}/data/{branch}")
        return reader.load(folders).select(*whole.names)

    def vacuum(self, spark: SparkSession) -> int:
        """Delete attempts that no manifest names; no batch may be being written meanwhile."""
        named = {(r.branch, r.batch, r.attempt) for r in self.manifests(spark).collect()}
        gone = 0
        for branch in session.listed(spark, f"{self.path}/data"):
            for batch in session.listed(spark, f"{self.path}/data/{branch}"):
                for attempt in session.listed(spark, f"{self.path}/data/{branch}/{batch}"):
                    place = (branch, int(batch.split("=")[1]), attempt.split("=")[1])
                    if place not in named:
                        session.discard(spark, self._attempt(*place))
                        gone += 1
        return gone


def fan_out_whole(
    stream: DataFrame,
    shapes: Mapping[str, Callable[[DataFrame], DataFrame]],
    table: WholeBatches,
    checkpoint: str,
) -> DataStreamWriter:
    """Write every row of a stream to every branch; the branches of a batch appear together.

    A batch is written once to the shared folder, from which the branches are made.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if table.committed(spark, batch_id):
            return
        folder = session.work_folder(spark, "batch")
        try:
            batch.write.parquet(folder)
            held = spark.read.schema(batch.schema).parquet(folder)
            table.write({name: shape(held) for name, shape in shapes.items()}, batch_id)
        finally:
            session.discard(spark, folder)

    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
