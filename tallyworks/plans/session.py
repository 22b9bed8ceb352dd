"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Let a table hashed by reference serve joins on (reference, period, ...).

    All rows of a reference share a partition, so windows and joins on longer keys need no
    further shuffle.  A reference has one row per month and question, which bounds it.
    A task that writes a table kept by reference holds few buckets and keeps their files
    open side by side, which spares sorting its rows by bucket.  Partition counts and memory
    stay as the cluster sets them.
    """
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "100")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
