import os
import tempfile

import pytest
from conftest import settings
from pyspark.sql import functions as F

from wardline.operators import output, privacy
from wardline.operators.tables import DAILY, DIAGNOSES, LABS


def dx(spark, *data):
    return spark.createDataFrame(
        list(data),
        "siteid string, icd_code_3chars string, icd_version int, "
        + ", ".join(f"{c} long" for c in DIAGNOSES.counts),
    )


def test_order_and_ties(spark):
    table = dx(
        spark,
        ("S", "B00", 10, 1, 5, 0, 0),
        ("S", "A00", 10, 1, 5, 0, 0),
        ("S", "A00", 9, 1, 5, 0, 0),
        ("S", "C00", 10, 2, 5, 0, 0),
        ("S", "D00", 10, 9, 7, 0, 0),
    )
    ordered = [(r.icd_code_3chars, r.icd_version) for r in output.as_table(table, DIAGNOSES).collect()]
    assert ordered == [("D00", 10), ("C00", 10), ("A00", 9), ("A00", 10), ("B00", 10)]
    lines = output.as_csv_lines(table, DIAGNOSES).collect()
    assert [r.i for r in lines] == [0, 1, 2, 3, 4, 5, 9999999]
    assert lines[0].s == ",".join(DIAGNOSES.with_site)
    assert lines[1].s == "S,D00,10,9,7,0,0" and lines[-1].s == ""


def test_numbers_nulls_and_dates(spark):
    row = {c: 0.1 for c in LABS.with_site}
    row.update(siteid="S", loinc="A", days_since_admission=-3, units=None, num_patients_all=12)
    row.update(num_patients_ever_severe=-99, mean_value_all=12345678.9, stdev_value_all=0.0000004,
               mean_log_value_all=None, stdev_log_value_all=-999.0)
    kinds = {c: "double" for c in LABS.with_site}
    kinds.update(siteid="string", loinc="string", units="string", days_since_admission="int",
                 num_patients_all="long", num_patients_ever_severe="long")
    table = spark.createDataFrame(
        [tuple(row[c] for c in LABS.with_site)], ", ".join(f"{c} {kinds[c]}" for c in LABS.with_site)
    )
    line = output.as_csv_lines(table, LABS).collect()[1].s.split(",")
    assert line[:5] == ["S", "A", "-3", "", "12"]
    assert line[5:9] == ["12345678.900000", "0.000000", "", "-999.000000"]
    assert line[9:] == ["-99", "0.100000", "0.100000", "0.100000", "0.100000"]

    day = spark.sql("select 'S' siteid, date'2020-03-01' calendar_date").select(
        "*", *[F.lit(1).cast("long").alias(c) for c in DAILY.counts]
    )
    assert output.as_csv_lines(day, DAILY).collect()[1].s == "S,2020-03-01,1,1,1,1,1"


def test_empty_table_still_has_header_and_blank_line(spark):
    lines = output.as_csv_lines(dx(spark), DIAGNOSES).collect()
    assert [r.i for r in lines] == [0, 9999999]


def test_one_file_per_table(spark):
    directory = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    lines = output.as_csv_lines(dx(spark, *[("S", f"A{i:02d}", 10, 1, 99 - i, 0, 0) for i in range(60)]), DIAGNOSES)
    path = output.write_report(lines.repartition(5), directory, output.file_name(DIAGNOSES, "S"))
    assert path == f"{directory}/Diagnoses-S.csv"
    with open(path) as f:
        text = f.read().split("\n")
    assert len(text) == 63 and text[0].startswith("siteid,icd") and text[-2:] == ["", ""]
    assert [line.split(",")[1] for line in text[1:61]] == [f"A{i:02d}" for i in range(60)]
    assert [n for n in os.listdir(directory) if not n.startswith(".")] == ["Diagnoses-S.csv"]


def test_protected_table_keeps_report_columns(spark):
    table = dx(spark, ("S", "A00", 10, 20, 30, 0, 0)).drop("siteid")
    cfg = settings()
    done = output.as_table(privacy.with_site(privacy.protect(table, DIAGNOSES, cfg), cfg), DIAGNOSES)
    assert done.columns == DIAGNOSES.with_site


def test_the_last_line_stays_last_in_a_long_table(spark, monkeypatch):
    monkeypatch.setattr(output, "LAST_LINE", 3)
    df = spark.range(10).selectExpr("'S' AS siteid", "DATE '2020-01-01' + CAST(id AS INT) AS calendar_date", *[
        f"id AS {c}" for c in DAILY.counts
    ])
    lines = output.as_csv_lines(df, DAILY).collect()
    assert [r.i for r in lines] == list(range(12)) and lines[-1].s == ""


def test_a_failed_write_leaves_nothing(spark):
    directory = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bad = spark.range(1).selectExpr("id AS i", "CAST(raise_error('no') AS STRING) AS s")
    with pytest.raises(Exception, match="no"):
        output.write_report(bad, directory, "x.csv")
    assert not os.listdir(directory)
