"""Python workers that find this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reachable(spark: SparkSession) -> SparkSession:
    """Lets the workers of a session import this package from where the driver has it.

    Harmless where it is installed or shipped already, or where that folder doesn't exist.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join(filter(None, [*paths, ROOT]))
    return spark


#: What the C library and Arrow may keep of freed memory in a worker, which goes on from task to task.
LEAN = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: Rows of a batch between executors and workers.
BATCH = 512


def lean(spark: SparkSession) -> SparkSession:
    """Bounds what texts on their way to and from Python workers take of an executor, for the rest of the session.

    By default a batch is 10,000 rows, often all of a task, held by the executor and the worker, as input and as output.
    Results that are not run yet are planned with what the session says then, so this is not taken back; a
    smaller batch of the session's, and values that the environment has, stay.
    """
    environment, name = spark.sparkContext.environment, "spark.sql.execution.arrow.maxRecordsPerBatch"
    for key, value in LEAN.items():
        environment.setdefault(key, value)
    before = int(spark.conf.get(name))
    if before <= 0 or before > BATCH:  # 0 and less: no limit
        spark.conf.set(name, str(BATCH))
    return reachable(spark)
