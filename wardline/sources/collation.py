"""Codes compared as a site's database compares them.

Many databases ignore case and trailing blanks when they compare text; a site that relies on
it has codes spelled in several ways, and an exact comparison would lose their rows without
a word.  Giving the code columns a collation changes every comparison made of them, joins
and groups included, and Spark still hashes and sorts them.  It costs pushed-down filters:
parquet statistics know nothing of collations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.sources.maps import Maps
from wardline.sources.readers import Sources

ANY_CASE = "UTF8_LCASE_RTRIM"  # without regard to case and trailing blanks
CODE_COLUMNS = ("concept_cd", "inout_cd", "sex_cd", "race_cd", "vital_status_cd", "local_code", "local_lab_code", "local_med_code")


def collated(df: DataFrame, collation: str) -> DataFrame:
    """``df`` with its code columns compared by ``collation``; values stay as they are."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in df.columns if c in CODE_COLUMNS})


def with_collation(sources: Sources, maps: Maps, collation: str) -> tuple[Sources, Maps]:
    """Tables and maps whose codes are compared by ``collation``.  Paths of concepts stay exact."""
    tables = (sources.facts, sources.visits, sources.patients, sources.concepts)
    rows = (maps.code_map, maps.lab_map, maps.med_map)
    return Sources(*(collated(t, collation) for t in tables)), Maps(*(collated(m, collation) for m in rows))
