"""Sessions for tests and benchmarks. On a cluster, pass your own session to every function."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str, master: str, shuffle_partitions: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
