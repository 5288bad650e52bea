"""Row numbers over tables of any size.

A window without a partition sorts all rows in one task.  Here rows are dealt out by range
of the order, sorted and numbered in each task, and written; the tasks' row counts, added
up along the ranges, then say where each task's numbers begin.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.storage import write_table

_IN_TASK = 33  # bits of Spark's own row ids that count within a task


def numbered(df: DataFrame, order: list[Column], name: str = "i", written: list[str] | None = None) -> DataFrame:
    """``df`` with its rows numbered from 1 in the given order, as column ``name``.

    Writes the rows once: ranges are cut from a sample, and a second run might cut them
    elsewhere.  What reaches the driver is one count per task.  ``written`` collects the
    path of the table, for the owner to remove.  Rows that tie are numbered in any order.
    """
    spark = df.sparkSession
    in_task = df.repartitionByRange(*order).sortWithinPartitions(*order)
    path = write_table(in_task.withColumn(name, F.monotonically_increasing_id()), "numbered")
    if written is not None:
        written.append(path)
    rows = spark.read.parquet(path)
    task = F.shiftright(name, _IN_TASK).cast("int")
    counts = {r["task"]: r["n"] for r in rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()}
    sizes = [counts.get(k, 0) for k in range(max(counts, default=0) + 1)]
    before = [0, *accumulate(sizes)][: len(sizes)]
    within = F.col(name).bitwiseAND(F.lit((1 << _IN_TASK) - 1))
    begins = F.element_at(F.lit(before).cast("array<bigint>"), task + 1)
    return rows.withColumn(name, begins + within + 1)
