"""Written intermediates and size checks.

A step that several later steps read is written once, as parquet, to the folder
the cluster names in ``spark.checkpoint.dir``.  That cuts the lineage, survives
the loss of any executor, and gives the planner the true size of the table.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def tables_written() -> Iterator[list[str]]:
    """Collects the paths of the tables written inside, for the owner to remove."""
    found: list[str] = []
    token = _written.set(found)
    try:
        yield found
    finally:
        _written.reset(token)


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder.

    ``spark.checkpoint.dir`` rules.  Only where it is unset, a folder set on the context
    serves.  A session whose executor is the driver itself (``local`` or ``local[n]``, as in
    tests) gets a temporary one; every other master must name a shared folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/wardline-{context.applicationId}"


def write_table(df: DataFrame, name: str, cluster_by: str | None = None) -> str:
    """Write ``df`` to a new folder and return its path.

    ``cluster_by`` is for tables cut out of a much larger one: rows are first spread into
    files of even size, ordered by that column.  Without it each task of a large scan
    would leave one small file; with it filters on the column skip most row groups.
    Spark splits a value that would fill several files.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (found := _written.get()) is not None:
        found.append(path)
    if cluster_by:
        df = df.hint("rebalance", cluster_by).sortWithinPartitions(cluster_by)
    df.write.parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> tuple[str, str]:
    """Write ``df`` as a catalog table bucketed and sorted by ``key``; return its name and path.

    Joins and aggregations by ``key`` of tables with the same number of buckets need no
    shuffle.  Rows are spread so that a bucket is written as one file; Spark splits the
    writing of one that has grown too large, but each is read by one task, so rows of one
    key should have been reduced before.
    """
    spark = df.sparkSession
    unique = f"wardline_{name}_{uuid.uuid4().hex}"
    path = f"{scratch_folder(spark)}/{unique}"
    spread = df.hint("rebalance", buckets, F.col(key))
    spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(unique)
    return unique, path


def materialize(df: DataFrame, name: str, cluster_by: str | None = None) -> DataFrame:
    """Write ``df`` and return it as read back."""
    path = write_table(df, name, cluster_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`write_table` made."""
    files, where = file_system(spark, path)
    files.delete(where, True)


def fits_broadcast(df: DataFrame) -> bool:
    """True when the planner would broadcast ``df``: its own size estimate, its own limit.

    No job runs.  Written tables and literal rows have known sizes; anything whose
    size is unknown is estimated high and so does not fit.
    """
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit
