"""Session builder."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app_name: str = "cardproof", **conf: str) -> SparkSession:
    """Get or create a session with the settings every stage relies on.

    Adaptive execution, skew-join handling and the 10 MB broadcast limit are Spark defaults. Master,
    memory and the number of shuffle partitions belong to ``spark-submit`` or to ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
