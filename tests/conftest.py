from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("WARDLINE_DRIVER_MEMORY", "4g")

from pyspark.sql import types as T  # noqa: E402

from wardline.config import SiteConfig  # noqa: E402
from wardline.session import local_session  # noqa: E402
from wardline.sources import schemas  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


COHORT = T.StructType(
    [
        T.StructField("patient_num", T.LongType()),
        T.StructField("admission_date", T.DateType()),
        T.StructField("severe", T.IntegerType()),
        T.StructField("severe_date", T.DateType()),
        T.StructField("death_date", T.DateType()),
    ]
)
ADMISSIONS = "patient_num long, admission_date date, discharge_date date"
POSITIVES = "patient_num long, covid_pos_date date"


def d(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


class Tables:
    """Small frames, one method per table, with the unnamed columns null."""

    def __init__(self, spark):
        self.spark = spark

    def _make(self, rows, schema):
        return self.spark.createDataFrame(rows, schema)

    def facts(self, *rows):
        """(patient, concept, start[, value[, text]])"""
        full = [(r[0], r[1], ts(r[2]), *(r[3:]), *([None] * (5 - len(r)))) for r in rows]
        return self._make(full, schemas.OBSERVATION_FACT)

    def visits(self, *rows):
        """(patient, start, end, type)"""
        return self._make([(p, ts(s), ts(e), k) for p, s, e, k in rows], schemas.VISIT_DIMENSION)

    def patients(self, *rows):
        """dicts"""
        names = schemas.PATIENT_DIMENSION.names
        return self._make([tuple(r.get(n) for n in names) for r in rows], schemas.PATIENT_DIMENSION)

    def concepts(self, *rows):
        return self._make(list(rows), schemas.CONCEPT_DIMENSION)

    def code_map(self, *rows):
        return self._make(list(rows), schemas.CODE_MAP)

    def lab_map(self, *rows):
        return self._make(list(rows), schemas.LAB_MAP)

    def med_map(self, *rows):
        return self._make(list(rows), schemas.MED_MAP)

    def positives(self, *rows):
        return self._make([(p, d(x)) for p, x in rows], POSITIVES)

    def admissions(self, *rows):
        return self._make([(p, d(a), d(b)) for p, a, b in rows], ADMISSIONS)

    def cohort(self, *rows):
        """(patient, admission[, severe date[, death date]])"""
        full = []
        for r in rows:
            p, a, s, x = (*r, *([None] * (4 - len(r))))
            full.append((p, d(a), 0 if s is None else 1, d(s), d(x)))
        return self._make(full, COHORT)


@pytest.fixture
def make(spark):
    return Tables(spark)


def settings(**changes) -> SiteConfig:
    return SiteConfig(**{"as_of": date(2020, 12, 31), "blur_salt": "salt", **changes})


def rows(df, *columns):
    """Rows as sorted tuples, dates as text."""
    data = df.select(*columns).collect() if columns else df.collect()

    def plain(v):
        return v.isoformat() if isinstance(v, date) else v

    return sorted((tuple(plain(v) for v in r) for r in data), key=lambda r: [str(x) for x in r])
