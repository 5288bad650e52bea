"""From positive tests to the admitted cohort."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.clinical import first_day
from wardline.operators.scope import join_codes, lookup
from wardline.storage import fits_broadcast


def index_events(facts: DataFrame, code_map: DataFrame, code: str = "covidpos") -> DataFrame:
    """First day a mapped positive code was recorded for each patient."""
    codes = code_map.filter(F.col("code") == code).select(F.col("local_code").alias("concept_cd"))
    return (
        join_codes(facts.select("patient_num", "concept_cd", "start_date"), codes, "left_semi")
        .groupBy("patient_num")
        .agg(first_day(F.min("start_date")).alias("covid_pos_date"))
    )


def index_events_by_result(facts: DataFrame, codes: list[str], value: str = "positive") -> DataFrame:
    """First day one of ``codes`` was recorded with the given result text (any case)."""
    return (
        facts.filter(F.col("concept_cd").isin(codes) & (F.lower("tval_char") == value.lower()))
        .groupBy("patient_num")
        .agg(first_day(F.min("start_date")).alias("covid_pos_date"))
    )


def admissions(
    visits: DataFrame, positives: DataFrame, code_map: DataFrame, as_of: date, lookback: int = 7
) -> DataFrame:
    """Distinct inpatient stays that start no earlier than ``lookback`` days before the index.

    Stays of patients without an index event are dropped before the rest are made
    distinct.  A patient may bring several index days: the earliest one decides, as any of
    them may admit a stay.
    """
    inpatient = code_map.filter(F.col("code") == "inpatient").select(
        F.col("local_code").alias("inout_cd")
    )
    found = lookup(
        visits.select("patient_num", "start_date", "end_date", "inout_cd"),
        inpatient,
        "inout_cd",
        ["patient_num", "start_date"],
        "left_semi",
    )
    stays = found.select(
        "patient_num",
        first_day("start_date").alias("admission_date"),
        F.coalesce(F.to_date("end_date"), F.lit(as_of)).alias("discharge_date"),
    )
    earliest = positives.groupBy("patient_num").agg(F.min("covid_pos_date").alias("covid_pos_date"))
    if fits_broadcast(positives):
        earliest = F.broadcast(earliest)  # no larger than the positives
    return (
        stays.join(earliest, "patient_num")
        .filter(F.col("admission_date") >= F.date_sub("covid_pos_date", lookback))
        .select("patient_num", "admission_date", "discharge_date")
        .distinct()
    )


def cohort(positives: DataFrame, admissions: DataFrame, window: int = 14) -> DataFrame:
    """Patients admitted no later than ``window`` days after the index, with the first such day.

    The first admission of all is the first qualifying one, if any qualifies, so both
    sides shrink to one row per patient before they meet.
    """
    latest = positives.groupBy("patient_num").agg(F.max("covid_pos_date").alias("covid_pos_date"))
    first = admissions.groupBy("patient_num").agg(F.min("admission_date").alias("admission_date"))
    return (
        first.join(latest, "patient_num")
        .filter(F.col("admission_date") <= F.date_add("covid_pos_date", window))
        .select(
            "patient_num",
            "admission_date",
            F.lit(0).alias("severe"),
            F.lit(None).cast("date").alias("severe_date"),
            F.lit(None).cast("date").alias("death_date"),
        )
    )
