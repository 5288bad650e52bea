"""Keeping the cohort up to date with new facts and visits.

What the cohort needs of a patient's history is little, and it can be merged: the first
index day, the days of inpatient admission, the days with evidence of severe illness and
the day of the last fact.  ``CohortState`` keeps one such row per patient in parts (by a
hash of the patient).  Folding new rows in reads them, and the parts their patients are
in; only those parts are written again.  Older facts are never read again.

Each piece of state is a minimum, a maximum or a set, so a row may come twice, late, or
together with others in any order, and a fold may be repeated.  Evidence before admission
is kept too, as a late fact can move an admission.  Parts are replaced when all of them
have been written; a driver that is killed while they are moved into place can lose the
part it moves, so keep the folds' input until they return.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.functions.clinical import first_day, severe_by_code
from wardline.operators import death
from wardline.operators.scope import join_codes, lookup
from wardline.operators.severity import severe_concepts
from wardline.sources.maps import Maps
from wardline.storage import file_system, scratch_folder

PARTS = 64
LOOKBACK, WINDOW = 7, 14  # days around the index day, as in operators.cohort


def _merged(rows: DataFrame) -> DataFrame:
    """One row per patient from rows of state."""
    def union(column: str):
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)

    return rows.groupBy("patient_num").agg(
        F.min("first_index").alias("first_index"), union("admission_days"), union("severe_days"), F.max("last_day").alias("last_day")
    )


def state_of(facts: DataFrame, visits: DataFrame, maps: Maps, cfg: SiteConfig) -> DataFrame:
    """(patient_num, first_index, admission_days, severe_days, last_day) of every patient in some facts and visits.

    Facts shrink to one row per patient and day, in each task, before they are shuffled.
    """
    positive = maps.code_map.filter(F.col("code") == "covidpos").select(F.col("local_code").alias("concept_cd"), F.lit(True).alias("positive"))
    mapped = severe_concepts(maps.lab_map, maps.med_map).select("concept_cd", F.lit(True).alias("mapped"))
    no = F.lit(None).cast("boolean")
    marks = positive.withColumn("mapped", no).union(mapped.select("concept_cd", no, "mapped")).groupBy("concept_cd").agg(
        F.max("positive").alias("positive"), F.max("mapped").alias("mapped")
    )
    marked = join_codes(facts.select("patient_num", "concept_cd", "start_date"), marks, "left")
    severe = F.coalesce(F.col("mapped") | severe_by_code(F.col("concept_cd"), cfg), F.lit(False))
    days = marked.groupBy("patient_num", first_day("start_date").alias("day")).agg(
        F.max(F.coalesce("positive", F.lit(False))).alias("positive"), F.max(severe).alias("severe")
    )
    inpatient = maps.code_map.filter(F.col("code") == "inpatient").select(F.col("local_code").alias("inout_cd")).distinct()
    stays = lookup(visits.select("patient_num", "start_date", "inout_cd"), inpatient, "inout_cd", ["patient_num", "start_date"], "left_semi")
    stays = stays.select("patient_num", first_day("start_date").alias("day")).distinct()
    nothing = F.lit(None).cast("date")
    rows = days.select("patient_num", "day", "positive", "severe", F.lit(False).alias("admission"), F.col("day").alias("last_day"))
    rows = rows.unionByName(
        stays.select("patient_num", "day", F.lit(False).alias("positive"), F.lit(False).alias("severe"), F.lit(True).alias("admission"), nothing.alias("last_day"))
    )

    def days_where(flag: str):
        return F.array_sort(F.collect_set(F.when(F.col(flag), F.col("day"))))

    return rows.filter(F.col("patient_num").isNotNull()).groupBy("patient_num").agg(
        F.min(F.when(F.col("positive"), F.col("day"))).alias("first_index"),
        days_where("admission").alias("admission_days"), days_where("severe").alias("severe_days"), F.max("last_day").alias("last_day"),
    )


def cohort_of(state: DataFrame) -> DataFrame:
    """The cohort with severe illness flagged, from state alone: no join, and no shuffle."""
    opens, closes = F.date_sub("first_index", LOOKBACK), F.date_add("first_index", WINDOW)
    admitted = state.select(
        "*", F.array_min(F.filter("admission_days", lambda d: d >= opens)).alias("admission_date")
    ).filter(F.col("admission_date") <= closes)
    return admitted.select(
        "patient_num", "admission_date",
        F.array_min(F.filter("severe_days", lambda d: d >= F.col("admission_date"))).alias("severe_date"), "last_day",
    ).select(
        "patient_num", "admission_date", F.col("severe_date").isNotNull().cast("int").alias("severe"), "severe_date",
        F.lit(None).cast("date").alias("death_date"), "last_day",
    )


def _rules(maps: Maps, cfg: SiteConfig) -> str:
    """A fingerprint of the maps and settings that state depends on; the order of rows does not matter."""
    codes = maps.code_map.filter(F.col("code").isin("covidpos", "inpatient")).select(F.lit("code").alias("map"), "code", "local_code")
    severe = severe_concepts(maps.lab_map, maps.med_map).select(F.lit("severe"), F.lit(""), "concept_cd")
    rows = codes.union(severe).distinct()
    n, mixed = rows.agg(F.count("*"), F.expr("bit_xor(xxhash64(map, code, local_code))")).first()
    prefixes = [cfg.code_prefix_icd9cm, cfg.code_prefix_icd10cm, cfg.code_prefix_icd9proc, cfg.code_prefix_icd10pcs]
    return "|".join([str(n), str(mixed), *prefixes])


class CohortState:
    """The state of all patients, in a folder that outlives the run."""

    def __init__(self, spark: SparkSession, path: str | None = None, parts: int = PARTS) -> None:
        """``path`` must be a folder that all executors share; a new one below the checkpoint folder by default.

        ``parts`` holds for a new folder; an old one keeps its own number.
        """
        self.spark = spark
        self.path = (path or f"{scratch_folder(spark)}/cohort-state-{uuid.uuid4().hex}").rstrip("/")
        self._parts = parts

    def _exists(self, what: str) -> bool:
        files, where = file_system(self.spark, f"{self.path}/{what}")
        return files.exists(where)

    def _settings(self, rules: str) -> int:
        """The number of parts, after a check that the folder was made with the same maps and settings."""
        if not self._exists("rules/_SUCCESS"):
            rows = self.spark.createDataFrame([(rules, self._parts)], "rules string, parts int")
            rows.write.mode("overwrite").parquet(f"{self.path}/rules")
            return self._parts
        held = self.spark.read.parquet(f"{self.path}/rules").first()
        if held["rules"] != rules:
            raise ValueError("maps or code prefixes have changed: fold all facts and visits into a new state")
        return held["parts"]

    def rows(self) -> DataFrame:
        """One row per patient, with its ``part``."""
        return self.spark.read.parquet(f"{self.path}/patients")

    def fold(self, facts: DataFrame, visits: DataFrame, maps: Maps, cfg: SiteConfig) -> None:
        """Merge new facts and visits in.  Repeating a fold changes nothing."""
        parts = self._settings(_rules(maps, cfg))
        new = state_of(facts, visits, maps, cfg).withColumn("part", F.pmod(F.xxhash64("patient_num"), F.lit(parts)).cast("int"))
        staged = f"{self.path}/new-{uuid.uuid4().hex}"
        new.write.partitionBy("part").parquet(staged)
        try:
            fresh = self.spark.read.schema(new.schema).parquet(staged)
            touched = sorted(r["part"] for r in fresh.select("part").distinct().collect())
            if not touched:
                return
            if self._exists("patients"):
                held = self.rows().select(new.columns).filter(F.col("part").isin(touched))
                fresh = held.unionByName(fresh)
            merged = _merged(fresh).withColumn("part", F.pmod(F.xxhash64("patient_num"), F.lit(parts)).cast("int"))
            spread = merged.repartition("part")
            spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/patients")
        finally:
            files, where = file_system(self.spark, staged)
            files.delete(where, True)

    def cohort(self, patients: DataFrame, cfg: SiteConfig) -> DataFrame:
        """The cohort with severity and death dates, as a run over all facts would find it."""
        found = cohort_of(self.rows())
        dated = death.death_dates(found.drop("last_day"), patients, cfg.death_data_accurate)
        if not (cfg.death_data_accurate and cfg.correct_death_by_last_fact):
            return dated
        later = F.when(F.col("death_date").isNotNull(), F.greatest("death_date", "last_day")).alias("death_date")
        return dated.join(found.select("patient_num", "last_day"), "patient_num").select(
            "patient_num", "admission_date", "severe", "severe_date", later
        )
