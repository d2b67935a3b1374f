from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
PATHS = [str(ROOT), str(ROOT / "tests")]
sys.path[:0] = PATHS
# Python workers import the package and the test modules as well.
os.environ["PYTHONPATH"] = os.pathsep.join([*PATHS, os.environ.get("PYTHONPATH", "")])

from gaugeflow import session  # noqa: E402
from gaugeflow.sources.endpoint_config import packaged_config  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    running = session.tune(builder.getOrCreate())
    running.sparkContext.setLogLevel("ERROR")
    yield running
    running.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def config():
    return packaged_config()


@pytest.fixture
def plan_of():
    def executed(df) -> str:
        return df.sparkSession._jvm.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "formatted"
        )

    return executed
