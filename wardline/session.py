"""A session for local work and tests; on a cluster the submitter's settings rule."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wardline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("WARDLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the session's Python workers, once per application.

    Workers of operators with Python code import it; where it is not installed on the
    executors, they find it in this archive.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="wardline-"), "wardline")
        context.addPyFile(shutil.make_archive(archive, "zip", root, "wardline"))
        _shipped.add(context.applicationId)
