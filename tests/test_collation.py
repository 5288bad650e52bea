import pytest
from conftest import SMALL, rows, settings
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardline.operators.tables import TABLES
from wardline.plans.report import raw_table
from wardline.plans.study import Study
from wardline.sources.collation import ANY_CASE, collated, with_collation
from wardline.sources.maps import Maps
from wardline.sources.readers import Sources


def study(make, spell, **changes):
    facts = make.facts(
        (1, spell("POS"), "2020-03-01"), (1, spell("GAS"), "2020-03-05"), (1, spell("DIAG|ICD10:I10"), "2020-03-04"),
        (2, spell("POS"), "2020-03-01"), (2, spell("DIAG|ICD10:J80"), "2020-03-04"), (2, spell("WBC"), "2020-03-03", 5.0),
        (1, spell("WBC"), "2020-03-03", 7.0), (1, spell("PILL"), "2020-03-09"), (2, spell("DEM|HISP:Y"), "2019-01-01"),
    )
    visits = make.visits((1, "2020-03-02", "2020-03-08", spell("IN")), (2, "2020-03-02", None, spell("IN")))
    patients = make.patients(dict(patient_num=1, sex_cd=spell("F"), race_cd=spell("W"), age_in_years_num=40), dict(patient_num=2, sex_cd=spell("M")))
    maps = Maps(
        make.code_map(("covidpos", "POS"), ("inpatient", "IN"), ("female", "F"), ("male", "M"), ("white", "W"), ("hispanic_latino", "DEM|HISP:Y")),
        make.lab_map(("6690-2", "WBC", 1.0, "u", "w"), ("2019-8", "GAS", 1.0, "mmHg", "g")),
        make.med_map(("ACEI", "ATC", "PILL")),
    )
    return Study(Sources(facts, visits, patients, make.concepts()), maps, settings(**changes))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_all_tables_whatever_the_spelling(spark, make, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        want = study(make, lambda c: c)
        got = study(make, lambda c: c.lower() + "  ", code_collation=ANY_CASE)
        for spec in TABLES:
            assert rows(raw_table(got, spec)) == rows(raw_table(want, spec)), spec.name
        assert rows(raw_table(got, TABLES[0]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_exact_by_default(make):
    assert rows(study(make, lambda c: c.lower()).admitted) == []
    assert len(rows(study(make, lambda c: c).admitted)) == 2


def test_values_keep_their_spelling(spark):
    df = spark.createDataFrame([("Ab ", "x"), ("aB", "y")], "concept_cd string, concept_path string")
    found = collated(df, ANY_CASE)
    assert rows(found) == rows(df) and found.groupBy("concept_cd").count().count() == 1
    assert dict(found.dtypes)["concept_path"] == "string"


def test_joins_stay_equi_joins(spark, make, no_broadcast):
    s = study(make, lambda c: c.lower(), code_collation=ANY_CASE)
    plan = raw_table(s, TABLES[3])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_over_the_test_tables(spark):
    s = entry.study(spark, SMALL)
    sources, maps = with_collation(s.sources, s.maps, ANY_CASE)
    assert rows(Study(sources, maps, s.cfg).admitted) == rows(s.admitted)
