"""What the plans look like, and that the plans for large tables give the same rows."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from conftest import SMALL, rows, settings
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardline.operators import cohort, death, expansion, history, labs, scope, severity
from wardline.operators.tables import TABLES
from wardline.plans.report import raw_table
from wardline.storage import fits_broadcast, materialize


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def study(spark):
    return entry.study(spark, SMALL)


PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")


def steps(s):
    """The steps over facts and concepts, and the six tables."""
    return {
        "severe": severity.severe_events(s.sources.facts, s.admitted, s.lab_map, s.med_map, s.cfg),
        "labs": labs.labs(s.sources.facts, s.cohort, s.lab_map),
        "diagnoses": history.diagnoses(s.sources.facts, s.cohort, s.cfg),
        "medications": history.medications(s.sources.facts, s.cohort, s.med_map),
        "lab_map": expansion.expand_lab_map(s.lab_map, s.sources.concepts),
        "med_map": expansion.expand_med_map(s.med_map, s.sources.concepts, s.sources.facts, "\\SYN\\"),
        **{spec.name: raw_table(s, spec) for spec in TABLES},
    }


def test_nothing_is_paired_with_everything(study):
    for name, df in steps(study).items():
        found = plan(df)
        assert not any(p in found for p in PAIRING), name
        assert "Python" not in found and "ArrowEval" not in found, name


def test_nothing_is_paired_with_everything_when_nothing_fits(spark, no_broadcast):
    for name, df in steps(entry.study(spark, SMALL)).items():
        found = plan(df)
        assert not any(p in found for p in PAIRING), name
        assert not re.search(r"\bBroadcastHashJoin\b", found), name


def test_index_events_moves_only_aggregated_rows(study):
    """With mapped codes broadcast, the one shuffle carries one row per patient and task."""
    found = plan(cohort.index_events(study.sources.facts, study.code_map))
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)", found)
    assert shuffles[0] == "patient_num"
    after = found[found.index("Exchange hashpartitioning(patient_num"):]
    assert "partial_min" in after.split("\n")[1]


def _written(spark, df):
    return materialize(df, "test")


def test_date_bound_and_columns_reach_the_scan(spark, make):
    start = F.timestamp_add("HOUR", F.col("id"), F.lit(datetime(2020, 1, 1)))
    facts = _written(
        spark,
        spark.range(0, 20000, 1, 4).select(
            (F.col("id") % 50).alias("patient_num"),
            F.lit("DIAG|ICD10:I10").alias("concept_cd"),
            start.alias("start_date"),
            F.lit(1.0).alias("nval_num"),
            F.lit("x").alias("tval_char"),
        ),
    )
    members = _written(spark, make.cohort((1, "2021-06-01")))
    found = plan(history.diagnoses(facts, members, settings(), date(2021, 6, 1)))
    scan = next(line for line in found.split("\n") if "FileScan" in line and "concept_cd" in line)
    assert "GreaterThanOrEqual(start_date,2020-06-01" in scan
    assert "StringStartsWith" in scan
    schema = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["concept_cd", "patient_num", "start_date"]


def test_size_check(spark):
    small = materialize(spark.range(10).toDF("patient_num"), "small")
    assert fits_broadcast(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    assert not fits_broadcast(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    unknown = spark.createDataFrame([(1,)], "patient_num long")
    assert not fits_broadcast(unknown)


def hot_tables(spark, make):
    """One patient and one code hold a third of all facts each."""
    rng = random.Random(11)
    first = datetime(2019, 1, 1)
    codes = ["POS", "WBC", "DIAG|ICD10:I10", "DIAG|ICD9:401.9", "PILL", "SED", "OTHER"]
    facts = []
    for i in range(6000):
        p = 0 if rng.random() < 0.33 else rng.randrange(1, 60)
        c = "WBC" if rng.random() < 0.33 else rng.choice(codes)
        facts.append((p, c, first + timedelta(hours=rng.randrange(24 * 500)), float(rng.randrange(9)), None))
    from wardline.sources import schemas

    table = spark.createDataFrame(facts, schemas.OBSERVATION_FACT)
    members = make.cohort(*[(p, f"2020-0{1 + p % 3}-1{p % 9}", None) for p in range(0, 60, 2)])
    return facts, _written(spark, table), _written(spark, members)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_hot_patient_and_hot_code(spark, make, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts, table, members = hot_tables(spark, make)
        admitted = {r.patient_num: r.admission_date for r in members.collect()}

        def midnight(day):
            return datetime(day.year, day.month, day.day)

        lab_map = _written(spark, make.lab_map(("6690-2", "WBC", 1.0, "u", "w"), ("2019-8", "GAS", 1.0, "m", "g")))
        med_map = _written(spark, make.med_map(("ACEI", "ATC", "PILL"), ("SIANES", "ATC", "SED")))

        severe = {}
        for p, c, t, _, _ in facts:
            if c == "SED" and p in admitted and t >= midnight(admitted[p]):
                severe[p] = min(severe.get(p, t.date()), t.date())
        found = severity.severe_events(table, members, lab_map, med_map, settings())
        assert rows(found) == sorted(
            [(p, x.isoformat()) for p, x in severe.items()], key=lambda r: [str(v) for v in r]
        )

        day_values = {}
        for p, c, t, v, _ in facts:
            if c == "WBC" and p in admitted and t >= midnight(admitted[p]):
                day_values.setdefault(((t.date() - admitted[p]).days, p), []).append(v)
        per_day = {}
        for (day, _), values in day_values.items():
            per_day.setdefault(day, []).append(sum(values) / len(values))
        got = {r.days_since_admission: r for r in labs.labs(table, members, lab_map).collect()}
        assert {k: r.num_patients_all for k, r in got.items()} == {k: len(v) for k, v in per_day.items()}
        for k, v in per_day.items():
            assert got[k].mean_value_all == pytest.approx(sum(v) / len(v))

        wanted = [f for f in facts if f[0] in admitted]
        assert scope.facts_of(table, members).count() == len(wanted)

        windows = {}
        for p, c, t, _, _ in wanted:
            if c.startswith("DIAG|ICD10:") and t >= midnight(admitted[p] - timedelta(days=365)):
                flags = windows.setdefault(p, [0, 0])
                flags[0] |= t <= midnight(admitted[p] - timedelta(days=15))
                flags[1] |= t >= midnight(admitted[p])
        dx = history.diagnoses(table, members, settings(code_prefix_icd9cm=""))
        assert rows(dx, "num_patients_all_before_admission", "num_patients_all_since_admission") == [
            (sum(f[0] for f in windows.values()), sum(f[1] for f in windows.values()))
        ]

        last = {}
        for p, _, t, _, _ in wanted:
            last[p] = max(last.get(p, t.date()), t.date())
        dead = members.withColumn("death_date", F.lit(date(2019, 1, 1)))
        moved = death.correct_death_by_last_fact(dead, table)
        assert {r.patient_num: r.death_date for r in moved.collect()} == last
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_same_facts_for_cohorts_of_any_size(spark):
    kept = {}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            with entry.study(spark, SMALL) as study_:
                kept[threshold] = (rows(study_.facts), rows(study_.cohort))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert kept["10MB"] == kept["-1"] and kept["-1"][0]


def test_a_hot_key_is_dealt_out(spark, no_broadcast):
    """A third of all rows share a patient; no task gets more than a few parts of them."""
    spark.conf.set(scope.SALTS_CONF, "64")
    try:
        facts = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS patient_num", "id AS concept_cd", "id AS start_date")
        spread = scope.facts_of(facts, spark.range(30_000).toDF("patient_num"))
        joined = spread.repartition(1).count()
        assert joined == 30_000
        salted = facts.filter("patient_num = 0").withColumn(
            "salt", F.pmod(F.xxhash64("concept_cd", "start_date"), F.lit(scope.salts(facts)))
        )
        most = salted.groupBy("salt").count().agg(F.max("count")).first()[0]
        assert most < 3 * 10_000 / 64
    finally:
        spark.conf.unset(scope.SALTS_CONF)


def test_no_step_runs_a_job(spark, make):
    """Operators only build plans."""
    members = make.cohort((1, "2020-03-01"))
    facts = make.facts((1, "C", "2020-03-02", 1.0))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    severity.severe_events(facts, members, make.lab_map(), make.med_map(), settings(), date(2020, 3, 1))
    labs.labs(facts, members, make.lab_map(), 0, date(2020, 3, 1))
    history.diagnoses(facts, members, settings())
    history.medications(facts, members, make.med_map())
    assert not tracker.getJobIdsForGroup("plans")
    spark.sparkContext.setJobGroup("", "")


def test_stays_of_others_are_dropped_before_any_shuffle(study):
    found = plan(cohort.admissions(study.sources.visits, study.index_events, study.code_map, date(2020, 12, 31)))
    shuffles = [m.start() for m in re.finditer(r"Exchange hashpartitioning\(patient_num#\d+L?, admission_date", found)]
    assert len(shuffles) == 1 and "BroadcastHashJoin [patient_num" in found[shuffles[0]:]


def test_deceased_patients_meet_the_cohort_before_any_shuffle(study):
    found = plan(death.death_dates(study.severe_cohort, study.sources.patients))
    deepest = found[found.rindex("Exchange hashpartitioning"):]
    assert "LeftSemi" in deepest


def test_attributes_are_read_once(study):
    from wardline.operators import demographics

    found = plan(
        demographics.demographics_attrs(study.admitted, study.sources.patients, study.facts, study.code_map, settings())
    )
    assert len(re.findall(r"FileScan parquet.*c_custkey", found)) == 3  # sex, age, race
    assert len(re.findall(r"FileScan parquet.*concept_cd", found)) == 1


def test_six_tables_read_the_cut_facts(spark):
    """Stamping all tables cuts the cohort's facts out once; only the cut is read afterwards."""
    s = entry.study(spark, SMALL)
    found = plan(entry._site_stamped(s))
    assert "facts" in s.__dict__ and "lineitem.parquet" not in found
    s.close()
