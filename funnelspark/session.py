"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Hour strings and epochs are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # Joins carry no hints: Spark broadcasts a side only when its known size is
    # under the threshold, re-checks it at run time, and otherwise sort-merges
    # with skewed partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # `dt=2023-05-01` must stay a string, like `dt=2023-05-01T03`.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Sketch aggregation keeps one small sketch per segment; a few thousand
    # segments per task still fit, so do not fall back to sorting at 128.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # The JVM does not compile methods over 8,000 bytes, and fusing a funnel projection with a
    # sum over 27 keys makes longer ones. Those stages run as separate, compiled projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Bring a session made elsewhere to these settings; all of them can change at run time."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "funnelspark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
