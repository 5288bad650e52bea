"""Laboratory values per day since admission."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.clinical import SEVERE_LOINCS, first_day
from wardline.operators.daily import NOT_AVAILABLE
from wardline.operators.scope import join_codes, since

LOG_OFFSET = 0.5
VALUE_COLUMNS = ["mean_value", "stdev_value", "mean_log_value", "stdev_log_value"]


def labs(
    facts: DataFrame, cohort: DataFrame, lab_map: DataFrame, min_day: int = 0, first: date | None = None
) -> DataFrame:
    """Count, mean and spread of each lab by day since admission, all and ever severe.

    Values are scaled and averaged per patient and day first, before they meet the
    cohort; the day tables are then averaged over patients.  ``min_day`` opens the
    window (-60 also counts the two months before admission).  ``first`` as in
    :func:`~wardline.operators.severity.severe_events`.
    """
    return labs_of_days(lab_days(facts, lab_map, min_day, first), cohort, min_day)


def lab_days(facts: DataFrame, lab_map: DataFrame, min_day: int = 0, first: date | None = None) -> DataFrame:
    """Each patient's mean value and log value per lab and day: (patient_num, loinc, lab_units, day, value, log_value)."""
    scales = lab_map.filter(~F.col("loinc").isin(SEVERE_LOINCS)).select(
        F.col("local_lab_code").alias("concept_cd"), "loinc", "scale_factor", "lab_units"
    )
    value = F.col("nval_num") * F.col("scale_factor")
    recent = since(facts, first, min_day)
    return (
        join_codes(recent.filter(F.col("nval_num") >= 0), scales)
        .groupBy("patient_num", "loinc", "lab_units", first_day("start_date").alias("day"))
        .agg(F.avg(value).alias("value"), F.avg(F.ln(value + LOG_OFFSET)).alias("log_value"))
    )


def labs_of_days(days: DataFrame, cohort: DataFrame, min_day: int = 0) -> DataFrame:
    """The lab table from :func:`lab_days`."""
    members = cohort.select("patient_num", "admission_date", "severe")
    on_day = (
        days.join(members, "patient_num")
        .withColumn("days_since_admission", F.datediff("day", "admission_date"))
        .filter(F.col("days_since_admission") >= min_day)
    )

    def spread(column: Column) -> Column:
        return F.coalesce(F.stddev_samp(column), F.lit(0.0))

    severe = F.col("severe") == 1
    severe_count = F.sum("severe")

    def if_severe(statistic: Column) -> Column:
        return F.when(severe_count == 0, float(NOT_AVAILABLE)).otherwise(statistic)

    value, log_value = F.col("value"), F.col("log_value")
    severe_value, severe_log = F.when(severe, value), F.when(severe, log_value)
    return (
        on_day.groupBy("loinc", "days_since_admission", F.col("lab_units").alias("units"))
        .agg(
            F.count("*").alias("num_patients_all"),
            F.avg(value).alias("mean_value_all"),
            spread(value).alias("stdev_value_all"),
            F.avg(log_value).alias("mean_log_value_all"),
            spread(log_value).alias("stdev_log_value_all"),
            severe_count.alias("num_patients_ever_severe"),
            if_severe(F.avg(severe_value)).alias("mean_value_ever_severe"),
            if_severe(spread(severe_value)).alias("stdev_value_ever_severe"),
            if_severe(F.avg(severe_log)).alias("mean_log_value_ever_severe"),
            if_severe(spread(severe_log)).alias("stdev_log_value_ever_severe"),
        )
    )
