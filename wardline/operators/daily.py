"""Counts per calendar day and per day of stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.operators.calendar import calendar_bounds, hospital_stays

NOT_AVAILABLE = -999

DAILY_COUNTS = [
    "cumulative_patients_all",
    "cumulative_patients_severe",
    "cumulative_patients_dead",
    "num_patients_in_hospital_on_this_date",
    "num_patients_in_hospital_and_severe_on_this_date",
]
COURSE_COUNTS = [
    "num_patients_all_still_in_hospital",
    "num_patients_ever_severe_still_in_hospital",
]


def _change(key: str, at: Column, counts: list[str], amounts: dict[str, Column | int]) -> Column:
    """One step of a running total: at ``at``, the named counts change by these amounts."""
    fields = [at.alias(key)]
    for name in counts:
        amount = amounts.get(name, 0)
        amount = amount if isinstance(amount, Column) else F.lit(amount)
        fields.append(amount.cast("long").alias(name))
    return F.struct(*fields)


def _running_totals(steps: DataFrame, changes: DataFrame, key: str, counts: list[str]) -> DataFrame:
    """Sum all changes per step, then along the steps (report rows: one per calendar day)."""
    per_step = changes.groupBy(key).agg(*[F.sum(c).alias(c) for c in counts])
    so_far = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.join(per_step, key, "left").select(
        key, *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in counts]
    )


def daily_counts(
    dates: DataFrame, admissions: DataFrame, cohort: DataFrame, cfg: SiteConfig
) -> DataFrame:
    """Per calendar day: patients so far (all, severe, dead) and patients in hospital."""
    key = "calendar_date"
    total, severe, dead, inside, inside_severe = DAILY_COUNTS
    low, _ = calendar_bounds(dates)

    def event(column: str, count: str) -> Column:
        at = F.when(F.col(column).isNotNull(), F.greatest(F.col(column), low))
        return _change(key, at, DAILY_COUNTS, {count: 1})

    events = cohort.select(
        F.inline(
            F.array(
                event("admission_date", total),
                event("severe_date", severe),
                event("death_date", dead),
            )
        )
    )
    ill_from = F.greatest("start", "severe_date")
    ill = (F.col("severe_date").isNotNull() & (ill_from <= F.col("end"))).cast("int")
    after = F.date_add("end", 1)
    stays = hospital_stays(dates, admissions, cohort).select(
        F.inline(
            F.array(
                _change(key, F.col("start"), DAILY_COUNTS, {inside: 1}),
                _change(key, ill_from, DAILY_COUNTS, {inside_severe: ill}),
                _change(key, after, DAILY_COUNTS, {inside: -1, inside_severe: -ill}),
            )
        )
    )
    steps = dates.select(F.col("d").alias(key))
    counts = _running_totals(steps, events.unionByName(stays), key, DAILY_COUNTS)
    if not cfg.death_data_accurate:
        counts = counts.withColumn(dead, F.lit(NOT_AVAILABLE).cast("long"))
    return counts


def clinical_course(dates: DataFrame, admissions: DataFrame, cohort: DataFrame) -> DataFrame:
    """Per day since the cohort admission: patients still (or again) in hospital."""
    key = "days_since_admission"
    everyone, ever_severe = COURSE_COUNTS
    severe = F.col("severe")
    changes = hospital_stays(dates, admissions, cohort).select(
        F.inline(
            F.array(
                _change(
                    key,
                    F.datediff("start", "cohort_date"),
                    COURSE_COUNTS,
                    {everyone: 1, ever_severe: severe},
                ),
                _change(
                    key,
                    F.datediff("end", "cohort_date") + 1,
                    COURSE_COUNTS,
                    {everyone: -1, ever_severe: -severe},
                ),
            )
        )
    )
    low, _ = calendar_bounds(dates)
    steps = dates.select(F.datediff("d", low).alias(key))
    return _running_totals(steps, changes, key, COURSE_COUNTS).filter(F.col(everyone) > 0)
