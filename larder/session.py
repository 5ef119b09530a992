"""Session settings shared by the tests, the benchmark and ad-hoc use.

A cluster job brings its own session; nothing in the library depends on this
module. Shuffle parallelism is the one setting that must follow the data: the
default here suits a single machine, a cluster job sets it (or leaves adaptive
execution to coalesce a generous number).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "larder", cores: int | str = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # on one machine even small shuffles are worth a task per core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
