"""Diagnoses and medications before and since admission."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.functions.clinical import closing_day, first_day
from wardline.operators.scope import LOOKBACK_DAYS, join_codes, since

GAP_DAYS = 15
ICD_CHARS = 3

HISTORY_COUNTS = [
    "num_patients_all_before_admission",
    "num_patients_all_since_admission",
    "num_patients_ever_severe_before_admission",
    "num_patients_ever_severe_since_admission",
]


def _before_and_since(events: DataFrame, cohort: DataFrame, keys: list[str]) -> DataFrame:
    """Patients with an event per key: a year up to ``GAP_DAYS`` before admission, and since.

    An event within the gap counts in neither, but its key still appears.  Events shrink
    to distinct days before they meet the cohort, then to one row per patient and key.
    """
    days = events.select(
        "patient_num", *keys, first_day("start_date").alias("day"), closing_day("start_date").alias("closing")
    ).distinct()
    admitted = F.col("admission_date")
    flags = (
        days.join(cohort.select("patient_num", "admission_date", "severe"), "patient_num")
        .filter(F.col("day") >= F.date_sub(admitted, LOOKBACK_DAYS))
        .groupBy("patient_num", "severe", *keys)
        .agg(
            F.max((F.col("closing") <= F.date_sub(admitted, GAP_DAYS)).cast("int")).alias("before"),
            F.max((F.col("day") >= admitted).cast("int")).alias("since"),
        )
    )
    before, since, severe = F.col("before"), F.col("since"), F.col("severe")
    sums = [before, since, severe * before, severe * since]
    return flags.groupBy(keys).agg(*[F.sum(s).alias(n) for s, n in zip(sums, HISTORY_COUNTS)])


def diagnoses(
    facts: DataFrame, cohort: DataFrame, cfg: SiteConfig, first: date | None = None
) -> DataFrame:
    """Patients per three-character ICD code and version; both versions in one pass.

    An empty prefix switches a version off.  ``first`` as in
    :func:`~wardline.operators.severity.severe_events`.
    """
    concept = F.col("concept_cd")
    prefixes = {9: cfg.code_prefix_icd9cm, 10: cfg.code_prefix_icd10cm}
    prefixes = {version: p for version, p in prefixes.items() if p}

    def code(version: int, prefix: str) -> Column:
        short = F.substring(concept, len(prefix) + 1, ICD_CHARS)
        if cfg.code_collation:  # one spelling of codes that compare as equal
            short = F.upper(F.rtrim(F.collate(short, "UTF8_BINARY")))
        row = F.struct(short.alias("icd_code_3chars"), F.lit(version).alias("icd_version"))
        return F.when(concept.startswith(prefix), row)

    coded = F.lit(False)
    for prefix in prefixes.values():
        coded = coded | concept.startswith(prefix)
    none = F.lit(None).cast("struct<icd_code_3chars:string,icd_version:int>")
    codes = F.array_compact(F.array(none, *[code(v, p) for v, p in prefixes.items()]))
    events = (
        since(facts, first, -LOOKBACK_DAYS)
        .filter(coded)
        .select("patient_num", "start_date", F.inline(codes))
    )
    return _before_and_since(events, cohort, ["icd_code_3chars", "icd_version"])


def medications(
    facts: DataFrame, cohort: DataFrame, med_map: DataFrame, first: date | None = None
) -> DataFrame:
    """Patients per medication class.  ``first`` as in :func:`diagnoses`."""
    classes = med_map.select(F.col("local_med_code").alias("concept_cd"), "med_class").distinct()
    recent = since(facts, first, -LOOKBACK_DAYS)
    events = join_codes(recent.select("patient_num", "concept_cd", "start_date"), classes)
    return _before_and_since(events, cohort, ["med_class"])
