import pytest
from conftest import SMALL, rows

import __spark_entry__ as entry
from wardline.operators import cohort
from wardline.plans.views import FUNCTIONS, STEPS, VIEWS, SqlNames


def names_of(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_sql_alone_gives_the_steps_rows(spark):
    with entry.study(spark, SMALL) as s, SqlNames(s, "t1_", steps=True) as names:
        assert {f"t1_{n}" for n in [*VIEWS, *STEPS]} <= names_of(spark)
        assert rows(names.sql("SELECT * FROM t1_cohort")) == rows(s.cohort)
        by_result = names.sql(f"SELECT * FROM t1_index_events_by_result(array('{entry.POSITIVE_CODES[0]}'), 'POSITIVE')")
        assert rows(by_result) == rows(cohort.index_events_by_result(s.sources.facts, entry.POSITIVE_CODES[:1])) != []
        stays = names.sql("SELECT * FROM t1_admitted_between(DATE '2020-03-10', DATE '2020-03-20')")
        assert rows(stays) == rows(s.admissions.filter("admission_date BETWEEN '2020-03-10' AND '2020-03-20'")) != []
        counted = names.sql(
            "SELECT m.code, count(f.patient_num) AS n FROM t1_code_map m LEFT JOIN t1_observation_fact f ON f.concept_cd = m.local_code GROUP BY m.code"
        )
        per_code = {r.code: r.n for r in counted.collect()}
        facts = names.sql("SELECT count(*) AS n FROM t1_facts_of_code('covidpos')")
        assert facts.first().n == per_code["covidpos"] > 0


def test_names_are_released_and_results_stay(spark):
    s = entry.study(spark, SMALL)
    before = names_of(spark)
    with SqlNames(s, "t2_") as names:
        found = names.sql("SELECT count(*) AS n FROM t2_facts_of_code('covidpos')")
    assert names_of(spark) == before and found.first().n > 0
    with pytest.raises(Exception, match="t2_facts_of_code"):
        spark.sql("SELECT * FROM t2_facts_of_code('covidpos')")
    with SqlNames(s, "t2_"):
        pass


def test_names_in_use_are_not_replaced(spark):
    s = entry.study(spark, SMALL)
    spark.range(3).createTempView("t3_med_map")
    try:
        with pytest.raises(Exception, match="t3_med_map"):
            SqlNames(s, "t3_")
        assert names_of(spark) >= {"t3_med_map"} and not {"t3_observation_fact"} & names_of(spark)
        assert spark.table("t3_med_map").count() == 3
    finally:
        spark.catalog.dropTempView("t3_med_map")


def test_functions_do_not_scan_all_with_all(spark):
    s = entry.study(spark, SMALL)
    with SqlNames(s, "t4_") as names:
        for call in ("t4_facts_of_code('covidpos')", "t4_index_events_by_result(array('x'), 'y')"):
            plan = names.sql(f"SELECT * FROM {call}")._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert len(FUNCTIONS) == 2
