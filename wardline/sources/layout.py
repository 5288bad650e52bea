"""Facts stored by month, and read by month.

A bound on ``start_date`` skips row groups, but every file's footer has to be read for it.
Facts in one folder per month carry the month as a column, from which whole folders are
left out before any file is opened.  Within a month rows are sorted by concept, so filters
on codes skip row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.scope import MONTH


def write_facts_by_month(facts: DataFrame, path: str, mode: str = "error") -> None:
    """Write facts to one folder per month of ``start_date``; ``mode="append"`` adds a delivery.

    Rows are spread by month into files of even size: Spark splits a month that would fill
    several.  Facts without a date have a folder of their own.
    """
    month = (F.year("start_date") * 100 + F.month("start_date")).cast("int")
    marked = facts.withColumn(MONTH, month)
    spread = marked.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "concept_cd")
    spread.write.mode(mode).partitionBy(MONTH).parquet(path)


def read_facts_by_month(spark: SparkSession, path: str) -> DataFrame:
    """Facts that :func:`write_facts_by_month` wrote, with their month.

    Operators that are told a first day (:func:`~wardline.operators.scope.since`) open no
    folder of a month before it.
    """
    return spark.read.parquet(path)
