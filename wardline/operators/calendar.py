"""The calendar of a report, and hospital stays laid on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_list(cohort: DataFrame, as_of: date) -> DataFrame:
    """Every day from the first admission to ``as_of``, however many those are.

    An empty cohort, or one that starts after ``as_of``, has no calendar.
    """
    first = cohort.agg(F.min("admission_date").alias("first"))
    return first.filter(F.col("first") <= F.lit(as_of)).select(
        F.explode(F.sequence(F.col("first"), F.lit(as_of))).alias("d")
    )


def calendar_bounds(dates: DataFrame):
    """First and last calendar day, as scalar subqueries (null for an empty calendar)."""
    return dates.select(F.min("d")).scalar(), dates.select(F.max("d")).scalar()


def hospital_stays(dates: DataFrame, admissions: DataFrame, cohort: DataFrame) -> DataFrame:
    """When each cohort patient was in hospital: intervals that do not overlap.

    Stays before the cohort admission are left out, the rest are cut to the calendar.
    Where stays overlap, the later one is shortened, so a day counts once per patient
    and no stay has to be unrolled into days.  The window holds at most one row per
    patient and calendar day, however many stays a patient has.
    """
    low, high = calendar_bounds(dates)
    stays = admissions.select(
        "patient_num", F.col("admission_date").alias("from"), F.col("discharge_date").alias("to")
    )
    members = cohort.select(
        "patient_num", F.col("admission_date").alias("cohort_date"), "severe", "severe_date"
    )
    cut = (
        stays.join(members, "patient_num")
        .filter(F.col("from") >= F.col("cohort_date"))
        .select(
            "patient_num",
            "cohort_date",
            "severe",
            "severe_date",
            F.greatest("from", low).alias("start"),
            F.least("to", high).alias("end"),
        )
        .filter(F.col("start") <= F.col("end"))
        .groupBy("patient_num", "cohort_date", "severe", "severe_date", "start")
        .agg(F.max("end").alias("end"))
    )
    earlier = (
        Window.partitionBy("patient_num")
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        cut.withColumn("covered", F.max("end").over(earlier))
        .withColumn("start", F.greatest("start", F.date_add("covered", 1)))
        .filter(F.col("start") <= F.col("end"))
        .drop("covered")
    )
