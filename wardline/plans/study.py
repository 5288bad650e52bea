"""The steps up to the classified cohort, each written once when several steps read it."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.operators import calendar, cohort as cohort_steps, death, labs, severity
from wardline.operators.scope import facts_of, report_facts, since
from wardline.storage import fits_broadcast, remove, write_bucketed, write_table
from wardline.sources.collation import with_collation
from wardline.sources.maps import Maps
from wardline.sources.readers import Sources


class Study:
    """Sources, maps and settings of one run, and the steps derived from them.

    A property runs its step when first read; the tables it writes stay until the study is
    closed (it is a context manager).  ``positives`` replaces the index events
    found through the code map, for sites that find them otherwise.

    ``buckets`` keeps what has patients in it (admissions, cohort, facts, lab days) as catalog
    tables bucketed by ``patient_num``: each is shuffled once, when written, and the joins
    and aggregations by patient of all later steps need no shuffle.  That pays for cohorts
    too large to broadcast; take as many buckets as tasks should share the patients.
    """

    def __init__(
        self, sources: Sources, maps: Maps, cfg: SiteConfig, positives: DataFrame | None = None,
        buckets: int | None = None,
    ) -> None:
        if cfg.code_collation:
            sources, maps = with_collation(sources, maps, cfg.code_collation)
        self.sources = sources
        self.maps = maps
        self.cfg = cfg
        self._positives = positives
        self.buckets = buckets
        self._written: list[tuple[SparkSession, str]] = []
        self._tables: list[tuple[SparkSession, str]] = []

    @cached_property
    def code_map(self) -> DataFrame:
        """Written, so that its size is known and facts never shuffle to meet it."""
        return self._sized(self.maps.code_map, "code_map")

    @cached_property
    def lab_map(self) -> DataFrame:
        return self._sized(self.maps.lab_map, "lab_map")

    @cached_property
    def med_map(self) -> DataFrame:
        return self._sized(self.maps.med_map, "med_map")

    @cached_property
    def index_events(self) -> DataFrame:
        found = self._positives
        if found is None:
            found = cohort_steps.index_events(self.sources.facts, self.code_map)
        return self._write(found, "index_events")

    @cached_property
    def admissions(self) -> DataFrame:
        stays = cohort_steps.admissions(
            self.sources.visits, self.index_events, self.code_map, self.cfg.as_of
        )
        return self._by_patient(stays, "admissions")

    @cached_property
    def admitted(self) -> DataFrame:
        """The cohort before anyone is classified."""
        return self._by_patient(cohort_steps.cohort(self.index_events, self.admissions), "admitted")

    @cached_property
    def first_admission(self) -> date | None:
        """The cohort's first admission, read once; it becomes a literal in later steps."""
        return self.admitted.agg(F.min("admission_date")).first()[0]

    @cached_property
    def facts(self) -> DataFrame:
        """The cohort's facts that the report can use, written once: later steps read these.

        The same rows for cohorts of any size; a cohort too large to broadcast changes how
        the facts meet it, not which are kept.
        """
        facts = self.sources.facts.select("patient_num", "concept_cd", "start_date", "nval_num")
        usable = report_facts(
            facts, self.code_map, self.lab_map, self.med_map, self.cfg, self.first_admission
        )
        return self._by_patient(facts_of(usable, self.admitted), "facts", cluster_by="concept_cd")

    @property
    def usable_facts(self) -> DataFrame:
        """The cut facts where they have been written, else the fact table itself.

        A whole report pays for the cut once and reads it often; a single table does not.
        Every step gives the same rows from either.
        """
        return self.facts if self.buckets or "facts" in self.__dict__ else self.sources.facts

    @cached_property
    def lab_days(self) -> DataFrame:
        """Mean lab values per patient and day, which only the lab table reads."""
        days = labs.lab_days(self.usable_facts, self.lab_map, self.cfg.lab_min_day, self.first_admission)
        return self._by_patient(days, "lab_days") if self.buckets else days

    @cached_property
    def severe_cohort(self) -> DataFrame:
        """The cohort with severe illness flagged: all that five of the six tables need."""
        events = severity.severe_events(
            self.usable_facts, self.admitted, self.lab_map, self.med_map, self.cfg, self.first_admission
        )
        return self._by_patient(severity.flag_severe(self.admitted, events), "severe_cohort")

    @cached_property
    def cohort(self) -> DataFrame:
        """The cohort with death dates as well.

        The last fact of a deceased patient may have any code, so it is looked for in all
        facts, from the first death on.
        """
        cfg = self.cfg
        dated = death.death_dates(self.severe_cohort, self.sources.patients, cfg.death_data_accurate)
        if cfg.death_data_accurate and cfg.correct_death_by_last_fact:
            dated = self._write(dated, "deceased")
            first = dated.agg(F.min("death_date")).first()[0]
            facts = self.sources.facts
            if first is not None:
                facts = since(facts, first, 0)
                dated = death.correct_death_by_last_fact(dated, facts)
        return self._by_patient(dated, "cohort")

    @cached_property
    def dates(self) -> DataFrame:
        return calendar.date_list(self.admitted, self.cfg.as_of)

    def prepare(self) -> Study:
        """Run every step that several tables share."""
        _ = self.facts, self.severe_cohort, self.admissions, self.dates
        _ = self.code_map, self.lab_map, self.med_map
        return self


    def _write(self, df: DataFrame, name: str, cluster_by: str | None = None) -> DataFrame:
        path = write_table(df, name, cluster_by)
        self._written.append((df.sparkSession, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def own(self, spark: SparkSession, *paths: str) -> None:
        """Tables that others have written for this study, to be removed with its own."""
        self._written += [(spark, path) for path in paths]

    def _by_patient(self, df: DataFrame, name: str, cluster_by: str | None = None) -> DataFrame:
        if not self.buckets:
            return self._write(df, name, cluster_by)
        table, path = write_bucketed(df, name, "patient_num", self.buckets)
        self._tables.append((df.sparkSession, table))
        self._written.append((df.sparkSession, path))
        return df.sparkSession.table(table)

    def _sized(self, table: DataFrame, name: str) -> DataFrame:
        return table if fits_broadcast(table) else self._write(table, name)

    def close(self) -> None:
        """Remove every table this study has written."""
        while self._tables:
            spark, table = self._tables.pop()
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        while self._written:
            remove(*self._written.pop())

    def __enter__(self) -> Study:
        return self

    def __exit__(self, *error) -> None:
        self.close()
