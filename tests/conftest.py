from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    warehouse = tempfile.mkdtemp(prefix="phenospark-wh-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("phenospark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", warehouse)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="phenospark-ckpt-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir() -> str:
    return tempfile.mkdtemp(prefix="phenospark-test-", dir="/tmp")


def rows(df, order=None):
    """Collected rows as sorted tuples (NULLs first)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))
