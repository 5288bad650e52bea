import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardline.operators import output
from wardline.operators.numbering import numbered
from wardline.operators.tables import DAILY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n, parts", [(0, 3), (1, 4), (7, 16), (3000, 9)])
def test_numbers_follow_the_order(spark, n, parts):
    rng = random.Random(n)
    data = [(rng.choice(["a", "b", None]), k) for k in range(n)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, k long").repartition(parts)
    found = numbered(df, [F.col("g").desc(), F.col("k").asc()])
    got = [(r.g, r.k) for r in sorted(found.collect(), key=lambda r: r.i)]
    assert sorted(r.i for r in found.collect()) == list(range(1, n + 1))
    assert got == sorted(data, key=lambda x: ({"b": 0, "a": 1, None: 2}[x[0]], x[1]))


def test_ties_get_different_numbers(spark):
    found = numbered(spark.range(500).select(F.lit(1).alias("g")), [F.col("g")]).collect()
    assert sorted(r.i for r in found) == list(range(1, 501))


def test_no_window_and_no_single_task(spark):
    df = spark.range(2000).selectExpr("'S' AS siteid", "DATE '2000-01-01' + CAST(id AS INT) AS calendar_date", *[f"id AS {c}" for c in DAILY.counts])
    written = []
    lines = output.as_csv_lines(df, DAILY, written)
    assert "Window" not in plan(lines) and len(written) == 1
    assert [r.i for r in lines.collect()] == [*range(2001), output.LAST_LINE]


def test_a_report_removes_its_numbered_lines(spark):
    with entry.study(spark, SMALL) as s:
        from wardline.plans.report import Report

        lines = Report(s).csv_lines()
        assert {len(x.columns) for x in lines.values()} == {2}
        paths = [p for _, p in s._written]
        assert sum("/numbered-" in p for p in paths) == 6
    from wardline.storage import file_system

    assert not any(file_system(spark, p)[0].exists(file_system(spark, p)[1]) for p in paths)
