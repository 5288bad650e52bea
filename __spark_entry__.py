"""

``queries()[name](spark, sf_dir)`` runs a step over the whole test tables, seen as
clinical tables by ``wardline.sources.testdata``.  ``oracle_sql()[name]`` says the same
in plain SQL.
"""

from __future__ import annotations

import logging
import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from wardline.operators import (  # noqa: E402
    bloom,
    calendar,
    checks,
    cohort,
    death,
    demographics,
    expansion,
    intervals,
    labs,
    output,
    privacy,
    severity,
)
from wardline.operators.tables import (  # noqa: E402
    COURSE,
    DAILY,
    DEMOGRAPHICS,
    DIAGNOSES,
    LABS,
    MEDICATIONS,
    TABLES,
    TableSpec,
)
from wardline.plans.refresh import CohortState  # noqa: E402
from wardline.plans.report import Report, raw_table  # noqa: E402
from wardline.plans.study import Study  # noqa: E402
from wardline.session import ship_package  # noqa: E402
from wardline.plans.views import SqlNames  # noqa: E402
from wardline.sources import collation, layout, schemas, scripts, testdata  # noqa: E402
from wardline.sources.maps import Maps, default_med_map, local_rows, read_maps, read_rxnorm_classes  # noqa: E402
from wardline.sources.readers import Sources, read_csv  # noqa: E402
from wardline.storage import scratch_folder  # noqa: E402

try:  # the training-data operators and their pipeline can be left out of an installation
    import corpus_pipeline  # noqa: E402
    import wardline.llm.queries as llm  # noqa: E402
except ImportError as error:  # the operators, or a package that only they need
    logging.getLogger(__name__).warning("without training-data queries: %s", error)
    llm = None

POSITIVE_CODES = ["LOINC:COVID19POS", "LOCAL:COVIDPOS2"]

Query = Callable[[SparkSession, str], DataFrame]


def study(spark: SparkSession, sf_dir: str, years_apart: bool = False, buckets: int | None = None, **settings) -> Study:
    tables = testdata.sources(spark, sf_dir, years_apart)
    return Study(tables, testdata.maps(spark, tables.concepts), testdata.config(**settings), buckets=buckets)


def _over_study(step: Callable[[Study], DataFrame], **settings) -> Query:
    return lambda spark, sf_dir: step(study(spark, sf_dir, **settings))


def _shipped(query: Query) -> Query:
    """A query whose tasks import this package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def _rounded(df: DataFrame) -> DataFrame:
    """Fractions to six digits: two engines add floating-point numbers in different orders."""
    return df.select(
        *[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


def _attrs(s: Study) -> DataFrame:
    return demographics.demographics_attrs(
        s.admitted, s.sources.patients, s.usable_facts, s.code_map, s.cfg
    )


def _cohort_by_result(s: Study) -> DataFrame:
    positives = cohort.index_events_by_result(s.sources.facts, POSITIVE_CODES)
    by_result = Study(s.sources, s.maps, s.cfg, positives)
    return cohort.cohort(by_result.index_events, by_result.admissions)


def _with_maps(s: Study, lab_rows: DataFrame | None = None, med_rows: DataFrame | None = None) -> Study:
    """The study again, with rows added to its maps from the start."""
    lab_map = s.lab_map.unionByName(lab_rows) if lab_rows is not None else s.lab_map
    med_map = s.med_map.unionByName(med_rows) if med_rows is not None else s.med_map
    return Study(s.sources, Maps(s.code_map, lab_map, med_map), s.cfg)


def _expanded_labs(s: Study) -> DataFrame:
    wide = _with_maps(s, lab_rows=expansion.expand_lab_map(s.lab_map, s.sources.concepts))
    return _rounded(raw_table(wide, LABS))


def _expand_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part code below its brand's node."""
    tree, lab_map = testdata.brand_tree(spark, sf_dir)
    return expansion.expand_lab_map(lab_map, tree)


def _codes_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part code below the parts' root."""
    maps = local_rows(spark, [], schemas.CODE_MAP)
    return expansion.codes_under_path(testdata.concepts(spark, sf_dir), testdata.PART_ROOT, maps, "part")


def _expand_brand_meds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of each brand that were sold in large quantity."""
    tree, lab_map = testdata.brand_tree(spark, sf_dir)
    classes = lab_map.select(
        F.col("loinc").alias("med_class"), F.lit("Brand").alias("code_type"), F.col("local_lab_code").alias("local_med_code")
    )
    return expansion.expand_med_map(classes, tree, testdata.large_sales(spark, sf_dir), testdata.PART_ROOT)


def _report_files(s: Study) -> DataFrame:
    """Every line of the files that a report writes, read back."""
    folder = f"{scratch_folder(s.sources.facts.sparkSession)}/files-{uuid.uuid4().hex}"
    Report(s).write(folder)
    lines = s.sources.facts.sparkSession.read.text(f"{folder}/*.csv")
    return lines.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


def _cohort_facts(s: Study) -> DataFrame:
    """All facts of the cohort, most others dropped by a Bloom filter at the scan."""
    keys = s.admitted.select("patient_num")
    held = bloom.bloom_filter(keys, "patient_num")
    near = s.sources.facts.filter(held.may_hold(F.col("patient_num")))
    day = F.to_date("start_date").alias("day")
    return near.join(keys, "patient_num", "left_semi").select("patient_num", "concept_cd", day, "nval_num")


def _cohort_refreshed(s: Study) -> DataFrame:
    """The cohort from state that three deliveries were folded into, one of them twice."""
    state = CohortState(s.sources.facts.sparkSession, parts=8)
    day = F.to_date("start_date")
    deliveries = [
        (day < F.lit("2020-03-01")) & (F.col("patient_num") % 7 != 3),
        day >= F.lit("2020-03-01"),
        (day < F.lit("2020-03-01")) & (F.col("patient_num") % 7 == 3),
    ]
    for new in [*deliveries, deliveries[1]]:
        state.fold(s.sources.facts.filter(new), s.sources.visits.filter(new), s.maps, s.cfg)
    return state.cohort(s.sources.patients, s.cfg)


def _script_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lab map with a row per part, written as a script of INSERT statements and read back."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")

    def quoted(column) -> F.Column:
        return F.concat(F.lit("'"), F.replace(column, F.lit("'"), F.lit("''")), F.lit("'"))

    name = F.concat(F.lit("it's a part; (or "), F.col("p_type"), F.lit("), no'ne"))
    values = F.concat_ws(
        ",", quoted(F.col("p_brand")), quoted(F.concat(F.lit("PART:"), F.col("p_partkey").cast("string"))),
        (F.col("p_size") / 2).cast("string"), F.lit("null"), quoted(name),
    )
    statement = F.concat(
        F.lit("Insert into COVID_LAB_MAP (LOINC,LOCAL_LAB_CODE,SCALE_FACTOR,LAB_UNITS,LAB_NAME) values ("), values, F.lit(");")
    )
    lines = part.select(F.explode(F.array(F.lit("-- a part"), statement, F.lit(""), F.lit("commit;"))).alias("value"))
    folder = f"{scratch_folder(spark)}/script-{uuid.uuid4().hex}"
    lines.write.text(folder)
    return scripts.read_inserts(spark, folder, "covid_lab_map", schemas.LAB_MAP)


def _cohort_any_case(s: Study) -> DataFrame:
    """The cohort over codes in changed case and with trailing blanks, compared as most databases do."""
    def respelled(column: str, by: str) -> F.Column:
        changed = F.when(F.hash(by) % 2 == 0, F.lower(column)).otherwise(F.col(column))
        return F.when(F.hash(by) % 3 == 0, F.concat(changed, F.lit("  "))).otherwise(changed).alias(column)

    facts = s.sources.facts.withColumn("concept_cd", respelled("concept_cd", "start_date"))
    visits = s.sources.visits.withColumn("inout_cd", respelled("inout_cd", "start_date"))
    spelled = Sources(facts, visits, s.sources.patients, s.sources.concepts)
    cfg = replace(s.cfg, code_collation=collation.ANY_CASE)
    return Study(spelled, s.maps, cfg).admitted


def _index_events_sql(s: Study) -> DataFrame:
    """Index events by result, asked for in SQL alone."""
    with SqlNames(s, prefix=f"q{uuid.uuid4().hex}_") as names:
        prefix = names.prefix
        codes = ", ".join(f"'{c}'" for c in POSITIVE_CODES)
        return names.sql(f"SELECT * FROM {prefix}index_events_by_result(array({codes}), 'Positive')")


def _labs_by_month(s: Study) -> DataFrame:
    """Labs from facts stored by month."""
    spark = s.sources.facts.sparkSession
    folder = f"{scratch_folder(spark)}/months-{uuid.uuid4().hex}"
    layout.write_facts_by_month(s.sources.facts, folder)
    facts = layout.read_facts_by_month(spark, folder)
    found = labs.labs(facts, s.severe_cohort, s.lab_map, s.cfg.lab_min_day, s.first_admission)
    return _rounded(found.select(*LABS.columns))


def _written_csv(tables: dict[str, DataFrame], spark: SparkSession) -> str:
    folder = f"{scratch_folder(spark)}/extract-{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


def _from_csv(s: Study) -> Study:
    """The study over text extracts of its tables and maps: every value comes from a string."""
    spark, t = s.sources.facts.sparkSession, s.sources
    extract = _written_csv(
        {
            "observation_fact": t.facts, "visit_dimension": t.visits, "patient_dimension": t.patients,
            "concept_dimension": t.concepts, "code_map": s.code_map, "lab_map": s.lab_map, "med_map": s.med_map,
        },
        spark,
    )
    site_maps = read_maps(spark, *[f"{extract}/{name}.csv" for name in ("code_map", "lab_map", "med_map")])
    return Study(read_csv(spark, extract), site_maps, s.cfg)


def _rxnorm_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default medication map with a site's RxNorm file."""
    extract = _written_csv({"rxnorm": testdata.rxnorm_classes(spark, sf_dir)}, spark)
    return default_med_map(spark, rxnorm=read_rxnorm_classes(spark, f"{extract}/rxnorm.csv"))


def _medications_rxnorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medications whose RxNorm codes come from the site's file alone."""
    s = study(spark, sf_dir)
    return raw_table(Study(s.sources, Maps(s.code_map, s.lab_map, _rxnorm_map(spark, sf_dir)), s.cfg), MEDICATIONS)


def _csv_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of all parts as numbered CSV lines."""
    codes = _codes_of_parts(spark, sf_dir)
    return output.csv_lines(codes, ["code", "local_code"], [F.col("local_code").desc()])


def _expand_meds(s: Study) -> DataFrame:
    return expansion.expand_med_map(
        s.med_map, s.sources.concepts, s.sources.facts, testdata.MEDICATION_ROOT
    )


def _expanded_meds(s: Study) -> DataFrame:
    return raw_table(_with_maps(s, med_rows=_expand_meds(s)), MEDICATIONS)


def _site_stamped(s: Study) -> DataFrame:
    """Keys of all six tables; as in a report, the cohort's facts are cut out once for them."""
    s.prepare()
    parts = [
        privacy.with_site(raw_table(s, spec), s.cfg)
        .select(F.lit(spec.name).alias("table_name"), "siteid", F.concat_ws("|", *spec.key).alias("key"))
        for spec in TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def _rule_violations(s: Study) -> DataFrame:
    found = [
        (
            s.sources.facts,
            "observation_fact",
            [
                checks.unique("patient_num", "concept_cd", "start_date"),
                checks.not_null("nval_num"),
                checks.max_length("concept_cd", 16),
            ],
        ),
        (
            s.sources.visits,
            "visit_dimension",
            [checks.unique("patient_num", "start_date"), checks.not_null("end_date")],
        ),
        (s.sources.patients, "patient_dimension", [checks.not_null("age_in_years_num")]),
        (s.sources.concepts, "concept_dimension", checks.STEP_RULES["concept_dimension"]),
        (s.index_events, "index_events", checks.STEP_RULES["index_events"]),
        (s.admissions, "admissions", checks.STEP_RULES["admissions"]),
        (s.admitted, "cohort", checks.STEP_RULES["cohort"]),
        (s.code_map, "code_map", checks.MAP_RULES["code_map"]),
        (s.lab_map, "lab_map", checks.MAP_RULES["lab_map"]),
        (s.med_map, "med_map", checks.MAP_RULES["med_map"]),
    ]
    return reduce(DataFrame.unionByName, [checks.check_rules(*f) for f in found])


def _rule_violations_labs(s: Study) -> DataFrame:
    """A second unit for one lab breaks the key of the lab table."""
    second = local_rows(s.lab_map.sparkSession, [oracle.MIXED_UNITS_ROW], schemas.LAB_MAP)
    mixed = raw_table(_with_maps(s, lab_rows=second), LABS)
    return checks.check_rules(privacy.with_site(mixed, s.cfg), LABS.name, checks.OUTPUT_RULES[LABS.name])


def _of_table(spec: TableSpec) -> dict[str, Query]:
    """Protection and output of one table."""
    source, limit = oracle.SOURCE[spec.name], oracle.MASK[spec.name]

    def raw(s: Study) -> DataFrame:
        return _rounded(raw_table(s, spec))

    def stamped(s: Study) -> DataFrame:
        return privacy.with_site(privacy.protect(raw(s), spec, s.cfg), s.cfg)

    found = {
        f"blur_{source}": _over_study(
            lambda s: privacy.blur_counts(raw(s), spec, oracle.BLUR, s.cfg.blur_salt)
        ),
        f"masked_{source}": _over_study(lambda s: privacy.mask_table(raw(s), spec, limit)),
        f"table_{source}": _over_study(
            lambda s: output.as_table(stamped(s), spec), obfuscation_small_count_mask=limit
        ),
        f"csv_{source}": _over_study(
            lambda s: output.as_csv_lines(privacy.with_site(raw(s), s.cfg), spec)
        ),
        f"protected_{source}": _over_study(
            stamped,
            obfuscation_small_count_mask=limit,
            obfuscation_blur=oracle.BLUR,
            obfuscation_small_count_delete=True,
            obfuscation_demographics=True,
        ),
    }
    if spec.delete_if_all_small:
        found[f"deleted_{source}"] = _over_study(
            lambda s: privacy.delete_small(raw(s), spec.delete_if_all_small, limit)
        )
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: daily counts of the cohort over the smallest tables."""
    return queries()["daily_counts"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query: name -> (spark, directory of the tables) -> DataFrame."""
    found = {
        "index_events": _over_study(lambda s: cohort.index_events(s.sources.facts, s.code_map)),
        "index_events_result": _over_study(
            lambda s: cohort.index_events_by_result(s.sources.facts, POSITIVE_CODES)
        ),
        "admissions": _over_study(
            lambda s: cohort.admissions(s.sources.visits, s.index_events, s.code_map, s.cfg.as_of)
        ),
        "cohort": _over_study(lambda s: cohort.cohort(s.index_events, s.admissions)),
        "cohort_by_result": _over_study(_cohort_by_result),
        "severe_events": _over_study(
            lambda s: severity.severe_events(s.usable_facts, s.admitted, s.lab_map, s.med_map, s.cfg, s.first_admission)
        ),
        "cohort_severe": _over_study(lambda s: s.severe_cohort),
        "cohort_death": _over_study(
            lambda s: death.death_dates(s.severe_cohort, s.sources.patients, s.cfg.death_data_accurate)
        ),
        "cohort_death_corrected": _over_study(lambda s: s.cohort),
        "date_list": _over_study(lambda s: calendar.date_list(s.admitted, s.cfg.as_of)),
        "demographics_attrs": _over_study(_attrs),
        "demographics_attrs_birth_date": _over_study(_attrs, age_source="birth_date"),
        "daily_counts_long": _over_study(_raw(DAILY), years_apart=True),
        "clinical_course_long": _over_study(_raw(COURSE), years_apart=True),
        "diagnoses_icd10_only": _over_study(_raw(DIAGNOSES), code_prefix_icd9cm=""),
        "daily_counts_no_death": _over_study(_raw(DAILY), death_data_accurate=False),
        "demographics_birth_date": _over_study(_raw(DEMOGRAPHICS), age_source="birth_date"),
        "demographics_dedupe": _over_study(_raw(DEMOGRAPHICS), dedupe_race=True),
        "demographics_no_race": _over_study(_raw(DEMOGRAPHICS), include_race=False),
        "demographics_race_in_facts": _over_study(_raw(DEMOGRAPHICS), race_in_fact_table=True),
        "labs_before_admission": _over_study(_raw(LABS), lab_min_day=-60),
        "labs_expanded": _over_study(_expanded_labs),
        "medications_expanded": _over_study(_expanded_meds),
        "codes_under_path": lambda spark, sf_dir: testdata.positive_codes(
            spark, testdata.concepts(spark, sf_dir)
        ),
        "expand_lab_map": _over_study(lambda s: expansion.expand_lab_map(s.lab_map, s.sources.concepts)),
        "expand_lab_map_brands": _expand_brands,
        "expand_med_map_brands": _expand_brand_meds,
        "codes_under_path_parts": _codes_of_parts,
        "labs_bucketed": _over_study(_raw(LABS), buckets=8),
        "cohort_facts": _over_study(_cohort_facts),
        "cohort_refreshed": _over_study(_cohort_refreshed),
        "inpatients_by_date": _over_study(
            lambda s: intervals.inpatients_by_date(s.dates, s.admissions, s.severe_cohort)
        ),
        "cohort_any_case": _over_study(_cohort_any_case),
        "index_events_sql": _over_study(_index_events_sql),
        "labs_by_month": _over_study(_labs_by_month),
        "maps_from_script": _script_of_parts,
        "cohort_from_csv": _over_study(lambda s: _from_csv(s).cohort),
        "labs_from_csv": _over_study(lambda s: _rounded(raw_table(_from_csv(s), LABS))),
        "med_map_rxnorm": _rxnorm_map,
        "medications_rxnorm": _medications_rxnorm,
        "csv_codes_under_path_parts": _csv_of_parts,
        "report_files": _over_study(_report_files),
        "expand_med_map": _over_study(_expand_meds),
        "suppressed_demographics": _over_study(
            lambda s: privacy.suppress_combinations(raw_table(s, DEMOGRAPHICS))
        ),
        "masked_daily_counts_sentinels": _over_study(
            lambda s: privacy.mask_table(raw_table(s, DAILY), DAILY, oracle.MASK[DAILY.name], protect_sentinels=True),
            death_data_accurate=False,
        ),
        "site_stamped": _over_study(_site_stamped),
        "rule_violations": _over_study(_rule_violations),
        "rule_violations_labs": _over_study(_rule_violations_labs),
    }
    for spec in TABLES:
        found[oracle.SOURCE[spec.name]] = _over_study(_raw(spec))
        found.update(_of_table(spec))
    if llm:
        with_python = {**llm.QUERIES, "pipeline": corpus_pipeline.run}
        found.update({name: _shipped(query) for name, query in with_python.items()})
    return found


def _raw(spec: TableSpec) -> Callable[[Study], DataFrame]:
    return lambda s: _rounded(raw_table(s, spec))


def oracle_sql() -> dict[str, str]:
    """The same queries as plain SQL over the same tables, where SQL can say them."""
    found = oracle.all_queries()
    if llm:
        found.update(llm.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
