"""Expressions over facts, dates and patients."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.config import SiteConfig

# Age bands (label, first year, last year).
AGE_BANDS = [
    ("00to02", 0, 2),
    ("03to05", 3, 5),
    ("06to11", 6, 11),
    ("12to17", 12, 17),
    ("18to25", 18, 25),
    ("26to49", 26, 49),
    ("50to69", 50, 69),
    ("70to79", 70, 79),
]
OLDEST_BAND = ("80plus", 80)

# What counts as evidence of severe illness.
SEVERE_LOINCS = ["2019-8", "2703-7"]  # PaCO2, PaO2
SEVERE_MED_CLASSES = ["SIANES", "SICARDIAC"]
SEVERE_ICD10CM = ["J80", "J95.851"]
SEVERE_ICD9CM = ["518.82", "997.31"]
SEVERE_ICD10PCS = ["0BH17EZ"]
SEVERE_ICD9PROC = ["96.04", "96.70", "96.71", "96.72"]
SEVERE_ICD10PCS_STARTS = ["5A093", "5A094", "5A095"]


def first_day(ts: str | Column) -> Column:
    """The day a moment falls on.  ``ts >= day`` is the same as ``first_day(ts) >= day``."""
    return F.to_date(ts)


def closing_day(ts: str | Column) -> Column:
    """The first midnight at or after a moment.

    ``ts <= day`` (a day meaning its midnight) is the same as
    ``closing_day(ts) <= day``: 10:00 on day -15 is already too late for -15.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.to_date(ts)
    return F.when(ts > day, F.date_add(day, 1)).otherwise(day)


def age_band(years: Column) -> Column:
    label, oldest = OLDEST_BAND
    band = F.when(years >= oldest, label)
    for name, low, high in AGE_BANDS:
        band = band.when(years.between(low, high), name)
    return band.otherwise("other")


def age_in_years(cfg: SiteConfig) -> Column:
    if cfg.age_source == "birth_date":
        return full_years(F.col("birth_date"), cfg.as_of)
    return F.col("age_in_years_num")


def full_years(birth: Column, as_of: date) -> Column:
    return F.floor(F.months_between(F.lit(as_of), birth) / 12)


def severe_by_code(concept: Column, cfg: SiteConfig) -> Column:
    """Severe diagnoses and procedures; prefixes are literals, so no LIKE or regex traps."""
    exact = (
        [cfg.code_prefix_icd10cm + c for c in SEVERE_ICD10CM]
        + [cfg.code_prefix_icd9cm + c for c in SEVERE_ICD9CM]
        + [cfg.code_prefix_icd10pcs + c for c in SEVERE_ICD10PCS]
        + [cfg.code_prefix_icd9proc + c for c in SEVERE_ICD9PROC]
    )
    severe = concept.isin(exact)
    for start in SEVERE_ICD10PCS_STARTS:
        severe = severe | concept.startswith(cfg.code_prefix_icd10pcs + start)
    return severe
