"""Joining days to the intervals that cover them.

An interval is cut into slabs of time, and days meet the intervals of their slab in an
equi-join, so neither side is paired with all of the other.  Whether a day lies inside is
then tested exactly.  A long interval is kept once per slab, not once per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.calendar import hospital_stays
from wardline.operators.scope import lookup

SLAB_DAYS = 32


def _slab(day: Column | str, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def covered_days(
    intervals: DataFrame, days: DataFrame, spread_by: list[str], slab_days: int = SLAB_DAYS
) -> DataFrame:
    """Every interval (``start`` to ``end``, both included) with each of ``days`` (column ``d``) inside it.

    All columns of both sides.  ``spread_by`` are columns of the intervals that tell them
    apart: intervals of a slab are dealt out by them where the days are too many to
    broadcast.  Intervals that end before they start, or lack an end, cover nothing.
    """
    whole = intervals.filter(F.col("start") <= F.col("end"))
    slabs = F.sequence(_slab("start", slab_days), _slab("end", slab_days))
    cut = whole.select(*intervals.columns, F.explode(slabs).alias("slab"))
    marked = days.filter(F.col("d").isNotNull()).withColumn("slab", _slab("d", slab_days))
    met = lookup(cut, marked, "slab", spread_by)
    return met.filter(F.col("d").between(F.col("start"), F.col("end"))).select(*intervals.columns, *days.columns)


def inpatients_by_date(dates: DataFrame, admissions: DataFrame, cohort: DataFrame) -> DataFrame:
    """Who of the cohort was in hospital on each calendar day: (calendar_date, patient_num, severe).

    ``severe`` says whether severe illness had begun by then.  One row per patient and day,
    however many stays overlap.
    """
    stays = hospital_stays(dates, admissions, cohort).select("patient_num", "severe_date", "start", "end")
    return covered_days(stays, dates, ["patient_num", "start"]).select(
        F.col("d").alias("calendar_date"),
        "patient_num",
        F.coalesce(F.col("severe_date") <= F.col("d"), F.lit(False)).cast("int").alias("severe"),
    )
