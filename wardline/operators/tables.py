"""The six output tables: their columns, keys, counts and row order."""

from __future__ import annotations

from dataclasses import dataclass, field

from wardline.operators.daily import COURSE_COUNTS, DAILY_COUNTS
from wardline.operators.demographics import DEMOGRAPHIC_COUNTS, DIMENSIONS
from wardline.operators.history import HISTORY_COUNTS
from wardline.operators.labs import VALUE_COLUMNS


@dataclass(frozen=True)
class TableSpec:
    """Shape of one output table.

    ``order`` lists (column, descending); the columns after the report's own order only
    break ties.  ``blocks`` maps a count to the statistics that are hidden with it.
    ``delete_if_all_small`` are the counts that must all be small for a row to be deleted.
    """

    name: str
    key: list[str]
    columns: list[str]
    counts: list[str]
    order: list[tuple[str, bool]]
    blocks: dict[str, list[str]] = field(default_factory=dict)
    delete_if_all_small: list[str] = field(default_factory=list)

    @property
    def with_site(self) -> list[str]:
        return ["siteid", *self.columns]


def _ascending(*columns: str) -> list[tuple[str, bool]]:
    return [(c, False) for c in columns]


_SINCE_THEN_BEFORE = [(HISTORY_COUNTS[1], True), (HISTORY_COUNTS[0], True)]
_ALL, _SEVERE = ("all", "ever_severe")
_LAB_BLOCKS = {
    f"num_patients_{who}": [f"{c}_{who}" for c in VALUE_COLUMNS] for who in (_ALL, _SEVERE)
}

DAILY = TableSpec(
    name="DailyCounts",
    key=["calendar_date"],
    columns=["calendar_date", *DAILY_COUNTS],
    counts=DAILY_COUNTS,
    order=_ascending("calendar_date"),
    delete_if_all_small=DAILY_COUNTS[:1],
)
COURSE = TableSpec(
    name="ClinicalCourse",
    key=["days_since_admission"],
    columns=["days_since_admission", *COURSE_COUNTS],
    counts=COURSE_COUNTS,
    order=_ascending("days_since_admission"),
    delete_if_all_small=COURSE_COUNTS[:1],
)
DEMOGRAPHICS = TableSpec(
    name="Demographics",
    key=DIMENSIONS,
    columns=[*DIMENSIONS, *DEMOGRAPHIC_COUNTS],
    counts=DEMOGRAPHIC_COUNTS,
    order=_ascending(*DIMENSIONS),
)
LABS = TableSpec(
    name="Labs",
    key=["loinc", "days_since_admission"],
    columns=[
        "loinc",
        "days_since_admission",
        "units",
        *[c for count, values in _LAB_BLOCKS.items() for c in [count, *values]],
    ],
    counts=list(_LAB_BLOCKS),
    order=_ascending("loinc", "days_since_admission", "units"),
    blocks=_LAB_BLOCKS,
    delete_if_all_small=["num_patients_all"],
)
DIAGNOSES = TableSpec(
    name="Diagnoses",
    key=["icd_code_3chars", "icd_version"],
    columns=["icd_code_3chars", "icd_version", *HISTORY_COUNTS],
    counts=HISTORY_COUNTS,
    order=_SINCE_THEN_BEFORE + _ascending("icd_code_3chars", "icd_version"),
    delete_if_all_small=HISTORY_COUNTS[:2],
)
MEDICATIONS = TableSpec(
    name="Medications",
    key=["med_class"],
    columns=["med_class", *HISTORY_COUNTS],
    counts=HISTORY_COUNTS,
    order=_SINCE_THEN_BEFORE + _ascending("med_class"),
    delete_if_all_small=HISTORY_COUNTS[:2],
)

TABLES = [DAILY, COURSE, DEMOGRAPHICS, LABS, DIAGNOSES, MEDICATIONS]
