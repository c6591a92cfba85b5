"""Session helpers: a local session for tests and the bench, and the shared
checkpoint folder every job uses to cut lineage.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. Only local sessions (tests, bench) set one,
and only when it is unset.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "phenospark",
    event_log_dir: str | None = None,
) -> SparkSession:
    """A ``local[cores]`` session with the defaults the library is tuned for:
    ANSI on, AQE on (coalesce + skew join), UI off, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PHENOSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log_dir
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # sessions without a SparkContext handle
        return None


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", None)
    if master is None:
        try:
            master = spark.sparkContext.master
        except Exception:
            master = ""
    return str(master).startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. Only a local session (tests,
    local runs) gets a fresh temporary one when none is configured; on a
    cluster an unset ``spark.checkpoint.dir`` is an error, because a folder
    local to one machine is invisible to the executors."""
    existing = checkpoint_dir(spark)
    if existing:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(existing)
        except Exception:
            pass
        return existing
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor shares"
        )
    local = tempfile.mkdtemp(prefix="phenospark-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, local, ignore_errors=True)  # made here, so removed here
    try:
        spark.sparkContext.setCheckpointDir(local)
        return spark.sparkContext.getCheckpointDir()
    except Exception:
        return local
