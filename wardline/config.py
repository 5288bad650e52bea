"""Site settings.

One frozen object holds what a site decides.  Its fields are read while a plan
is built, so only literals reach Spark: a flag adds or leaves out a step, a
prefix becomes a constant in a filter.
"""

from __future__ import annotations

import re
import secrets
from dataclasses import dataclass, field, fields
from datetime import date

from pyspark.sql import DataFrame

SITE_ID_PATTERN = r"^[A-Za-z][A-Za-z0-9]{0,19}$"


@dataclass(frozen=True)
class SiteConfig:
    """Settings of one run.

    ``as_of`` stands for "today": it closes open stays and ends the calendar.
    The fields up to ``output_as_csv`` are the columns of a site's one-row
    config table; the ones after it choose between variants of a step.
    """

    as_of: date
    siteid: str = "YOURSITEID"
    include_race: bool = True
    race_in_fact_table: bool = False
    hispanic_in_fact_table: bool = True
    death_data_accurate: bool = True
    code_prefix_icd9cm: str = "DIAG|ICD9:"
    code_prefix_icd10cm: str = "DIAG|ICD10:"
    code_prefix_icd9proc: str = "PROC|ICD9:"
    code_prefix_icd10pcs: str = "PROC|ICD10:"
    obfuscation_blur: int = 0
    obfuscation_small_count_mask: int = 10
    obfuscation_small_count_delete: bool = False
    obfuscation_demographics: bool = False
    output_as_columns: bool = False
    output_as_csv: bool = True

    age_source: str = "stored"  # or "birth_date"
    correct_death_by_last_fact: bool = True
    lab_min_day: int = 0
    dedupe_race: bool = False
    protect_sentinels: bool = False
    code_collation: str = ""  # how codes are compared; exactly, if empty (see sources.collation)
    # Whoever knows the salt can undo the noise, so the default is a fresh secret.
    blur_salt: str = field(default_factory=lambda: secrets.token_hex(16), repr=False)

    def __post_init__(self) -> None:
        if not re.match(SITE_ID_PATTERN, self.siteid):
            raise ValueError(
                f"siteid {self.siteid!r}: up to 20 letters or digits, a letter first"
            )
        if self.age_source not in ("stored", "birth_date"):
            raise ValueError(f"age_source {self.age_source!r}: 'stored' or 'birth_date'")
        if self.obfuscation_blur < 0 or self.obfuscation_small_count_mask < 0:
            raise ValueError("blur and mask must not be negative")

    @classmethod
    def from_table(cls, config: DataFrame, as_of: date, **choices) -> SiteConfig:
        """Read the settings from a config table, which must hold exactly one row.

        Column names are matched without regard to case; flags may be stored as 0/1.  A
        missing column or a null leaves the default in place, but an empty or null code
        prefix switches that code version off: many databases and CSV readers make no
        difference between the two.
        """
        rows = config.limit(2).collect()
        if len(rows) != 1:
            raise ValueError("the config table must hold exactly one row")
        stored = {
            k.lower(): "" if v is None and k.lower().startswith("code_prefix_") else v
            for k, v in rows[0].asDict().items()
        }
        stored = {k: v for k, v in stored.items() if v is not None}
        settings = {}
        for f in fields(cls):
            if f.name in stored and f.name != "as_of":
                kind = {"bool": lambda v: bool(int(v)), "int": int, "str": str}[f.type]
                settings[f.name] = kind(stored[f.name])
        return cls(as_of=as_of, **{**settings, **choices})
