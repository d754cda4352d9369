"""The session's settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(name: str = "corpuscle", cores: int | str = "*", partitions: int | None = None, memory: str | None = None) -> SparkSession:
    """A session with adaptive execution, skew handling, UTC and Arrow; a running one is taken as it is.

    On a cluster the master, memory and partition count come from spark-submit; adaptive execution sizes partitions.
    """
    builder = SparkSession.builder.appName(name)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if not SparkSession.getActiveSession():
        import os

        if "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", "") and not os.environ.get("MASTER"):
            builder = builder.master(f"local[{cores}]")
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    if memory:
        conf["spark.driver.memory"] = memory
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
