"""Severe illness."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.functions.clinical import (
    SEVERE_LOINCS,
    SEVERE_MED_CLASSES,
    first_day,
    severe_by_code,
)
from wardline.operators.scope import join_codes, since


def severe_concepts(lab_map: DataFrame, med_map: DataFrame) -> DataFrame:
    """Local codes of blood-gas labs and of severe medication classes."""
    labs = lab_map.filter(F.col("loinc").isin(SEVERE_LOINCS)).select("local_lab_code")
    meds = med_map.filter(F.col("med_class").isin(SEVERE_MED_CLASSES)).select("local_med_code")
    return labs.union(meds).distinct().toDF("concept_cd")


def severe_events(
    facts: DataFrame,
    cohort: DataFrame,
    lab_map: DataFrame,
    med_map: DataFrame,
    cfg: SiteConfig,
    first: date | None = None,
) -> DataFrame:
    """First day at or after admission with evidence of severe illness.

    One pass over the facts finds both mapped codes and code patterns; what is left is
    one row per patient and day before it meets the cohort.  ``first`` is the cohort's
    first admission, if known: older facts are then left out where they are read.
    """
    mapped = severe_concepts(lab_map, med_map).withColumn("mapped", F.lit(True))
    recent = since(facts, first, 0)
    days = (
        join_codes(recent.select("patient_num", "concept_cd", "start_date"), mapped, "left")
        .filter(F.col("mapped") | severe_by_code(F.col("concept_cd"), cfg))
        .select("patient_num", first_day("start_date").alias("day"))
        .distinct()
    )
    return (
        days.join(cohort.select("patient_num", "admission_date"), "patient_num")
        .filter(F.col("day") >= F.col("admission_date"))
        .groupBy("patient_num")
        .agg(F.min("day").alias("severe_date"))
    )


def flag_severe(cohort: DataFrame, severe: DataFrame) -> DataFrame:
    """Set ``severe`` and ``severe_date`` for patients found in ``severe``."""
    first = severe.groupBy("patient_num").agg(F.min("severe_date").alias("found"))
    return cohort.join(first, "patient_num", "left").select(
        "patient_num",
        "admission_date",
        F.when(F.col("found").isNotNull(), 1).otherwise(F.col("severe")).alias("severe"),
        F.coalesce("found", "severe_date").alias("severe_date"),
        "death_date",
    )
