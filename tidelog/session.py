"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings the operators rely on; all can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed outer / semi / anti join is split even when that adds an exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Time-of-day columns of the source.
    "spark.sql.timeType.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay the cluster's own."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    from tidelog.sources import wal  # which itself needs run_dir

    # The batch function of the message decoder travels with the job, so the executors'
    # Python needs numpy and pyarrow but not this package.
    cloudpickle.register_pickle_by_value(wal)
    return spark


def local_session(cores: int | str = "*", app: str = "tidelog") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@functools.cache
def _own_folder() -> str:
    """Where a local session works that names no folder; gone when the process ends."""
    folder = tempfile.mkdtemp(prefix="tidelog-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder all executors can reach, under ``spark.checkpoint.dir``.

    A cluster must name that folder. Only where it is unset and the master is local, driver
    and executors being one process, the process has a folder of its own for its lifetime.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
