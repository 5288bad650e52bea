"""Ordered tables, CSV lines and files.

These steps see report rows only: one per calendar day, code or combination of codes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.text import csv_field
from wardline.operators.numbering import numbered
from wardline.operators.tables import TableSpec
from wardline.storage import file_system, remove

LAST_LINE = 9999999  # number of the blank last line; larger tables give it the next one


def _order(spec: TableSpec) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c, descending in spec.order]


def as_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table in its report order."""
    return df.select(*spec.with_site).orderBy(*_order(spec))


def as_csv_lines(df: DataFrame, spec: TableSpec, written: list[str] | None = None) -> DataFrame:
    """The table as text: line number ``i`` and line ``s``.

    Line 0 is the header and the last line is blank.  Read in order of ``i``.  ``written`` as
    in :func:`~wardline.operators.numbering.numbered`.
    """
    return csv_lines(df, spec.with_site, _order(spec), written)


def csv_lines(df: DataFrame, columns: list[str], order: list[Column], written: list[str] | None = None) -> DataFrame:
    """Any table as numbered lines, as :func:`as_csv_lines` does it."""
    types = {f.name: f.dataType for f in df.schema}
    line = F.concat_ws(",", *[csv_field(c, types[c]) for c in columns])
    body = numbered(df.withColumn("s", line), order, "i", written).select(F.col("i").cast("int").alias("i"), "s")
    last = F.greatest(F.lit(LAST_LINE), F.col("n").cast("int") + 1)
    ends = body.agg(F.count("*").alias("n")).select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("i"), F.lit(",".join(columns)).alias("s")),
                F.struct(last.alias("i"), F.lit("").alias("s")),
            )
        )
    )
    return body.unionByName(ends).orderBy("i")


def file_name(spec: TableSpec, siteid: str) -> str:
    return f"{spec.name}-{siteid}.csv"


def write_report(lines: DataFrame, directory: str, name: str) -> str:
    """Write CSV lines as one file ``directory/name`` and return its path.

    Spark writes a part file beside the target, which the file system then renames, so
    readers see the whole file or none.  An existing file is never replaced.
    """
    spark = lines.sparkSession
    staging = f"{directory.rstrip('/')}/_{name}-{uuid.uuid4().hex}"
    target = f"{directory.rstrip('/')}/{name}"
    files, where = file_system(spark, target)
    if files.exists(where):
        raise FileExistsError(target)
    try:
        lines.coalesce(1).sortWithinPartitions("i").select("s").write.text(staging)
        part = files.globStatus(file_system(spark, f"{staging}/part-*")[1])[0].getPath()
        if not files.rename(part, where):
            raise OSError(f"{target} could not be written")
    finally:
        remove(spark, staging)
    return target
