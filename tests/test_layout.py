import re

from conftest import SMALL, rows

import __spark_entry__ as entry
from wardline.operators import labs
from wardline.operators.tables import TABLES
from wardline.plans.report import Report, raw_table
from wardline.storage import file_system, write_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_and_groups_by_patient_need_no_exchange(spark, no_broadcast):
    with entry.study(spark, SMALL, buckets=8) as s:
        days, members = s.lab_days, s.severe_cohort
        joined = days.join(members, "patient_num").groupBy("patient_num", "loinc").count()
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        found = plan(labs.labs_of_days(days, members))
        below = found[found.index("SortMergeJoin"):]
        assert "Exchange" not in below and "Bucketed: true" in below
        assert found.count("Exchange hashpartitioning") == 1  # partial sums of the report's rows
        per_patient = s.facts.groupBy("patient_num").count().join(s.admissions, "patient_num")
        assert "Exchange" not in plan(per_patient)


def test_all_tables_are_the_same_with_and_without_buckets(spark):
    with entry.study(spark, SMALL) as a, entry.study(spark, SMALL, buckets=4) as b:
        for spec in TABLES:
            got, want = (raw_table(s, spec).selectExpr(*[f"round({c}, 6)" if k == "double" else c for c, k in raw_table(s, spec).dtypes]) for s in (b, a))
            assert rows(got) == rows(want), spec.name


def test_a_bucket_is_one_file_sorted_by_patient(spark):
    table, path = write_bucketed(spark.range(1000).selectExpr("id % 90 AS patient_num", "id AS k").repartition(7), "test", "patient_num", 6)
    files = [r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()]
    assert len(files) == 6
    for f in files:
        ids = [r[0] for r in spark.read.parquet(f).select("patient_num").collect()]
        assert ids == sorted(ids)
    assert spark.table(table).count() == 1000
    spark.sql(f"DROP TABLE {table}")


def test_catalog_and_folder_are_clean_after_closing(spark):
    report = Report(entry.study(spark, SMALL, buckets=4))
    with report:
        assert len(report.tables()) == 6
        s = report.study
        tables, paths = [t for _, t in s._tables], [p for _, p in s._written]
        assert len(tables) >= 4 and all(spark.catalog.tableExists(t) for t in tables)
    assert not any(spark.catalog.tableExists(t) for t in tables)
    assert not any(file_system(spark, p)[0].exists(file_system(spark, p)[1]) for p in paths)
    assert not [t.name for t in spark.catalog.listTables() if re.match("wardline_", t.name)]
