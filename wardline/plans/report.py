"""The whole report: six protected tables, as DataFrames, CSV lines or files."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame

from wardline.config import SiteConfig
from wardline.operators import checks, daily, demographics, history, labs, output, privacy
from wardline.operators.tables import (
    COURSE,
    DAILY,
    DEMOGRAPHICS,
    DIAGNOSES,
    LABS,
    MEDICATIONS,
    TABLES,
    TableSpec,
)
from wardline.plans.study import Study
from wardline.sources.maps import Maps
from wardline.sources.readers import Sources


def _demographics(study: Study) -> DataFrame:
    members, cfg = study.severe_cohort, study.cfg
    attrs = demographics.known_attributes(
        members, study.sources.patients, study.usable_facts, study.code_map, cfg, counted=True
    )
    return demographics.demographics(members, attrs, cfg)


BUILDERS: dict[str, Callable[[Study], DataFrame]] = {
    DAILY.name: lambda s: daily.daily_counts(s.dates, s.admissions, s.cohort, s.cfg),
    COURSE.name: lambda s: daily.clinical_course(s.dates, s.admissions, s.severe_cohort),
    DEMOGRAPHICS.name: _demographics,
    LABS.name: lambda s: labs.labs_of_days(s.lab_days, s.severe_cohort, s.cfg.lab_min_day),
    DIAGNOSES.name: lambda s: history.diagnoses(s.usable_facts, s.severe_cohort, s.cfg, s.first_admission),
    MEDICATIONS.name: lambda s: history.medications(
        s.usable_facts, s.severe_cohort, s.med_map, s.first_admission
    ),
}


def raw_table(study: Study, spec: TableSpec) -> DataFrame:
    """One table as counted, columns in report order, before any protection."""
    return BUILDERS[spec.name](study).select(*spec.columns)


class Report:
    """The six tables of a study.  Each is computed and written once, when first asked for."""

    def __init__(self, study: Study) -> None:
        self.study = study
        self._tables: dict[str, DataFrame] = {}

    def _compute(self, spec: TableSpec) -> DataFrame:
        cfg = self.study.cfg
        protected = privacy.protect(raw_table(self.study, spec), spec, cfg)
        return self.study._write(privacy.with_site(protected, cfg), spec.name)

    def table(self, spec: TableSpec) -> DataFrame:
        """One protected table with the site id in front."""
        if spec.name not in self._tables:
            self._tables[spec.name] = self._compute(spec)
        return self._tables[spec.name]

    def compute(self) -> Report:
        """All six at once: their jobs do not depend on each other and share the executors."""
        missing = [spec for spec in TABLES if spec.name not in self._tables]
        self.study.prepare()
        with ThreadPoolExecutor(len(TABLES)) as pool:
            done = list(pool.map(self._compute, missing))
        self._tables.update({spec.name: df for spec, df in zip(missing, done)})
        return self

    def tables(self) -> dict[str, DataFrame]:
        """All six, in report order."""
        self.compute()
        return {spec.name: output.as_table(self.table(spec), spec) for spec in TABLES}

    def _csv_lines(self, spec: TableSpec) -> DataFrame:
        table, written = self.table(spec), []
        lines = output.as_csv_lines(table, spec, written)
        self.study.own(table.sparkSession, *written)
        return lines

    def csv_lines(self) -> dict[str, DataFrame]:
        """All six as CSV lines, numbered at once."""
        self.compute()
        with ThreadPoolExecutor(len(TABLES)) as pool:
            return dict(zip([spec.name for spec in TABLES], pool.map(self._csv_lines, TABLES)))

    def results(self) -> dict[str, DataFrame]:
        """What the site's output flags ask for: ordered tables, CSV lines, or both."""
        found = {}
        if self.study.cfg.output_as_columns:
            found.update(self.tables())
        if self.study.cfg.output_as_csv:
            found.update({f"{name}CSV": lines for name, lines in self.csv_lines().items()})
        return found

    def close(self) -> None:
        """Remove every table that the report and its study have written."""
        self._tables.clear()
        self.study.close()

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def write(self, directory: str) -> list[str]:
        """One CSV file per table in ``directory``, if the site asks for CSV; returns their paths."""
        if not self.study.cfg.output_as_csv:
            return []
        siteid, lines = self.study.cfg.siteid, self.csv_lines()
        return [
            output.write_report(lines[spec.name], directory, output.file_name(spec, siteid)) for spec in TABLES
        ]

    def violations(self) -> DataFrame:
        """Rows that break the declared rules of the six tables."""
        self.compute()
        parts = [
            checks.check_rules(self.table(spec), spec.name, checks.OUTPUT_RULES[spec.name])
            for spec in TABLES
        ]
        return reduce(DataFrame.unionByName, parts)


def run_report(
    sources: Sources, maps: Maps, cfg: SiteConfig, positives: DataFrame | None = None,
    buckets: int | None = None,
) -> Report:
    """The report over a site's tables.  ``positives`` and ``buckets`` as in :class:`Study`."""
    return Report(Study(sources, maps, cfg, positives, buckets))
