"""Patient attributes and the demographics table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.functions.clinical import age_band, age_in_years
from wardline.operators.daily import NOT_AVAILABLE
from wardline.operators.scope import facts_of, join_codes, lookup
from wardline.storage import fits_broadcast

SEXES = ["male", "female"]
RACES = ["american_indian", "asian", "black", "hawaiian_pacific_islander", "white"]
ETHNICITIES = ["hispanic_latino"]

DIMENSIONS = ["sex", "age_group", "race"]
DEMOGRAPHIC_COUNTS = ["num_patients_all", "num_patients_ever_severe"]


def _coded(rows: DataFrame, local: str, code_map: DataFrame, codes: list[str], name: str) -> DataFrame:
    wanted = code_map.filter(F.col("code").isin(codes)).select(
        F.col("local_code").alias(local), F.col("code").alias(name)
    )
    found = lookup(rows.select("patient_num", local), wanted, local, ["patient_num"])
    return found.select("patient_num", name)


def _race_sources(cfg: SiteConfig) -> tuple[list[str], list[str]]:
    """Race codes to look for in the patient table, and in the facts."""
    if not cfg.include_race:
        return [], []
    in_facts = (RACES if cfg.race_in_fact_table else []) + (
        ETHNICITIES if cfg.hispanic_in_fact_table else []
    )
    return [c for c in RACES + ETHNICITIES if c not in in_facts], in_facts


def _coded_facts(facts: DataFrame, code_map: DataFrame, codes: list[str]) -> DataFrame:
    wanted = code_map.filter(F.col("code").isin(codes)).select(
        F.col("local_code").alias("concept_cd"), F.col("code").alias("race")
    )
    return join_codes(facts.select("patient_num", "concept_cd", "start_date"), wanted)


def known_attributes(
    cohort: DataFrame,
    patients: DataFrame,
    facts: DataFrame,
    code_map: DataFrame,
    cfg: SiteConfig,
    counted: bool = False,
) -> DataFrame:
    """One row per patient and recorded attribute: sex, age group or race, the others null.

    A race recorded n times gives n rows.  With ``counted`` rows carry a count ``n`` and
    equal ones may be one row, formed before a shuffle by patient where there is one.
    ``cfg.dedupe_race`` keeps one.
    """
    everyone = cohort.select("patient_num")

    def of_cohort(rows: DataFrame) -> DataFrame:
        if counted and fits_broadcast(everyone):  # the count over patients combines on the map side
            rows = rows.withColumn("n", F.lit(1).cast("long"))
        elif counted:
            rows = rows.groupBy(rows.columns).agg(F.count("*").alias("n"))
        return rows.join(everyone, "patient_num", "left_semi")

    ages = patients.select("patient_num", age_band(age_in_years(cfg)).alias("age_group"))
    parts = [of_cohort(_coded(patients, "sex_cd", code_map, SEXES, "sex")), of_cohort(ages)]
    in_patients, in_facts = _race_sources(cfg)
    races = []
    if in_patients:
        races.append(_coded(patients, "race_cd", code_map, in_patients, "race"))
    if in_facts and (counted or cfg.dedupe_race):
        races.append(_coded_facts(facts, code_map, in_facts).select("patient_num", "race"))
    elif in_facts:  # every row is kept, so the join itself has to spread them
        rows = facts_of(_coded_facts(facts, code_map, in_facts), cohort)
        parts.append(rows.select("patient_num", "race"))
    if cfg.dedupe_race and races:
        races = [reduce(DataFrame.unionByName, races).distinct()]
    parts += [of_cohort(rows) for rows in races]
    known = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if "race" not in known.columns:
        known = known.withColumn("race", F.lit(None).cast("string"))
    return known.select("patient_num", *DIMENSIONS, *(["n"] if counted else []))


def demographics_attrs(
    cohort: DataFrame, patients: DataFrame, facts: DataFrame, code_map: DataFrame, cfg: SiteConfig
) -> DataFrame:
    """All attribute rows, with an 'other' row for every attribute a patient lacks.

    A patient's distinct values meet in one short list (at most one entry per code), which
    shows what is missing; repeated rows travel as counts and are told apart at the end.
    """
    known = known_attributes(cohort, patients, facts, code_map, cfg, counted=True)
    values = known.groupBy("patient_num", *DIMENSIONS).agg(F.sum("n").alias("n"))
    lists = values.groupBy("patient_num").agg(F.collect_list(F.struct(*DIMENSIONS, "n")).alias("known"))
    fields = ",".join(f"{d}:string" for d in DIMENSIONS)
    listed = F.coalesce("known", F.array().cast(f"array<struct<{fields},n:bigint>>"))

    def other(dim: str) -> Column:
        row = F.struct(
            *[F.lit("other" if d == dim else None).cast("string").alias(d) for d in DIMENSIONS],
            F.lit(1).cast("long").alias("n"),
        )
        return F.when(~F.exists(listed, lambda x: x[dim].isNotNull()), row)

    rows = F.concat(listed, F.array_compact(F.array(*map(other, DIMENSIONS))))
    counted = cohort.select("patient_num").join(lists, "patient_num", "left").select("patient_num", F.inline(rows))
    return _repeated(counted, "n").select("patient_num", *DIMENSIONS)


def _repeated(rows: DataFrame, count: str) -> DataFrame:
    """Each row as often as its count says, unrolled a thousand at a time."""
    thousands = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / 1000))))
    rest = F.least(F.lit(999).cast("long"), F.col(count) - 1 - 1000 * F.col("part"))
    return thousands.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), rest))).drop("part", count)


def demographics(cohort: DataFrame, attrs: DataFrame, cfg: SiteConfig) -> DataFrame:
    """Counts for every combination of sex, age group and race, 'all' included.

    ``attrs`` are attribute rows, one per occurrence or with a count ``n``; a patient
    without an attribute counts as 'other'.  Each patient becomes one row with short
    lists (at most one entry per code) whose combinations are weighted by their counts,
    so repeated rows never multiply.
    """
    weight = F.sum("n") if "n" in attrs.columns else F.count("*")
    values = attrs.groupBy("patient_num", *DIMENSIONS).agg(weight.alias("n"))

    def entry(value) -> Column:
        return F.struct(value.alias("value"), F.col("n").cast("long").alias("n"))

    def fixed(value: str) -> Column:
        return F.array(F.struct(F.lit(value).alias("value"), F.lit(1).cast("long").alias("n")))

    profiles = values.groupBy("patient_num").agg(
        *[
            F.collect_list(F.when(F.col(d).isNotNull(), entry(F.col(d)))).alias(d)
            for d in DIMENSIONS
        ]
    )
    rows = cohort.select("patient_num", "severe").join(profiles, "patient_num", "left")
    for d in DIMENSIONS:
        listed = F.when(F.size(d) > 0, F.col(d)).otherwise(fixed("other"))
        rows = rows.withColumn(d, F.explode(F.concat(fixed("all"), listed)))
    times = F.col("sex.n") * F.col("age_group.n") * F.col("race.n")
    counts = rows.groupBy(*[F.col(f"{d}.value").alias(d) for d in DIMENSIONS]).agg(
        F.sum(times).alias("num_patients_all"),
        F.sum(times * F.col("severe")).alias("num_patients_ever_severe"),
    )
    if not cfg.include_race:
        for c in DEMOGRAPHIC_COUNTS:
            counts = counts.withColumn(c, F.lit(NOT_AVAILABLE).cast("long"))
    return counts
