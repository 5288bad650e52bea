import re

import pytest
from conftest import SMALL

import __spark_entry__ as entry
import oracle
from compare import compare, connect


def test_every_query_has_its_sql():
    own = {name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own == set(oracle.all_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 306 and df.columns[0] == "calendar_date"


@pytest.mark.parametrize(
    "name",
    ["index_events_result", "demographics_attrs", "labs_before_admission", "medications_expanded",
     "protected_demographics", "protected_labs", "csv_labs", "rule_violations"],
)
def test_rows_agree_with_sql(spark, name):
    same, note = compare(spark, connect(SMALL), name, SMALL)
    assert same, note
