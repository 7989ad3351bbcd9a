"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "hazardloom", master: str | None = None, partitions: int | None = None,
            **conf) -> SparkSession:
    """A session with adaptive execution and skew handling on; everything else is the cluster's."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), str(v))
    return b.getOrCreate()
