"""Session defaults for tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "12g", shared: str | None = None) -> SparkSession:
    """``shared`` is the folder of stage tables; without it one is made and goes with the process."""
    if shared is None:
        shared = tempfile.mkdtemp(prefix="letterloom-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("letterloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.minPartitionNum", str(2 * partitions))
        .config("spark.checkpoint.dir", shared)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
