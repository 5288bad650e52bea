"""Death dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.clinical import first_day
from wardline.operators.scope import lookup, rows_of


def death_dates(cohort: DataFrame, patients: DataFrame, accurate: bool = True) -> DataFrame:
    """Give deceased patients a death date, never before they fell severely ill or came in.

    Patients without a recorded death keep what they had; so does everyone when the site
    says its death data are not accurate.
    """
    if not accurate:
        return cohort
    dead = patients.filter(F.col("death_date").isNotNull() | (F.col("vital_status_cd") == "Y"))
    deceased = (
        lookup(dead, cohort.select("patient_num"), "patient_num", ["death_date"], "left_semi")
        .groupBy("patient_num")
        .agg(F.max(F.to_date("death_date")).alias("recorded"), F.lit(True).alias("deceased"))
    )
    earliest = F.coalesce("severe_date", "admission_date")
    return cohort.join(deceased, "patient_num", "left").select(
        "patient_num",
        "admission_date",
        "severe",
        "severe_date",
        F.when(F.col("deceased"), F.greatest("recorded", earliest))
        .otherwise(F.col("death_date"))
        .alias("death_date"),
    )


def correct_death_by_last_fact(cohort: DataFrame, facts: DataFrame) -> DataFrame:
    """Move a death date to the last fact when facts were recorded after it.

    A fact later on the day of death is after its midnight but leaves the same day, so
    the larger of the two days is the answer.  Facts of others are dropped first, then
    each patient's facts shrink to their last day before the join.
    """
    deceased = cohort.filter(F.col("death_date").isNotNull()).select("patient_num")
    last = (
        rows_of(facts.select("patient_num", "start_date"), deceased, ["start_date"])
        .groupBy("patient_num")
        .agg(first_day(F.max("start_date")).alias("last_day"))
    )
    return cohort.join(last, "patient_num", "left").select(
        "patient_num",
        "admission_date",
        "severe",
        "severe_date",
        F.when(F.col("death_date").isNotNull(), F.greatest("death_date", "last_day")).alias(
            "death_date"
        ),
    )
