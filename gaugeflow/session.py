"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    # Generated methods beyond 8000 bytes are never compiled by the JVM and run two to
    # five times slower; with this limit Spark splits such projections into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables partitioned by status, part or topic have few values per task. With a
    # writer for each of them open, a task need not sort its rows before writing.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str, **settings: str) -> SparkSession:
    """A tuned session; the master and its sizes come from the caller or spark-submit."""
    builder = SparkSession.builder.appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local run without one gets its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeflow-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder, used by one run only."""
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/gaugeflow/{application}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that nothing reads any more."""
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return []
    return [str(found.getPath().getName()) for found in files.listStatus(path)]


def listed_files(spark: SparkSession, folder: str) -> list[str]:
    """Files below a folder, at any depth."""
    files, path = _file_system(spark, folder)
    found, names = files.listFiles(path, True), []
    while found.hasNext():
        names.append(str(found.next().getPath()))
    return names


def made(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.mkdirs(path)


def renamed(spark: SparkSession, folder: str, new: str) -> None:
    """Give a folder another name, by which its readers see all of it or nothing."""
    files, path = _file_system(spark, folder)
    _, target = _file_system(spark, new)
    if files.exists(target) or not files.rename(path, target):
        raise RuntimeError(f"cannot rename {folder} to {new}")


#: With this setting Spark deletes the shuffles of a query when the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffles on the disks; none of it may be run again."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(rows: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write rows to the work folder and read them back.

    What follows reads the written table, so a lost executor costs one task and
    not the whole history of the rows.
    """
    spark = rows.sparkSession
    path = f"{work_folder(spark, purpose)}/table"
    with shuffles_let_go(spark):
        rows.write.partitionBy(*partition_by).parquet(path)
    schema = rows.schema
    made = spark.read.schema(schema).parquet(path).select(*schema.names)
    made.staged_at = path
    return made


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        discard(table.sparkSession, table.staged_at)
