import math

import pytest
from conftest import rows

from wardline.operators import labs

MAP = [
    ("6690-2", "WBC", 1.0, "u", "w"),
    ("1988-5", "CRP", 10.0, "mg", "c"),
    ("2160-0", "CREA", None, None, "n"),
    ("2019-8", "GAS", 1.0, "mm", "g"),
]


def by_day(table, loinc):
    return {r.days_since_admission: r for r in table.filter(f"loinc = '{loinc}'").collect()}


def test_two_level_means(make):
    members = make.cohort((1, "2020-03-10", "2020-03-10"), (2, "2020-03-10"))
    facts = make.facts(
        (1, "WBC", "2020-03-10 00:00", 2.0),
        (1, "WBC", "2020-03-10 23:00", 4.0),
        (2, "WBC", "2020-03-10 12:00", 7.0),
        (2, "WBC", "2020-03-10 13:00", None),  # dropped
        (2, "WBC", "2020-03-10 13:00", -5.0),  # dropped
        (2, "WBC", "2020-03-11 13:00", 0.0),  # zero stays
        (2, "WBC", "2020-03-09 23:59", 9.0),  # before admission
        (2, "GAS", "2020-03-10 13:00", 5.0),  # severity lab: not reported
        (2, "CRP", "2020-03-10 13:00", 5.0),
        (3, "WBC", "2020-03-10 13:00", 5.0),
    )
    table = labs.labs(facts, members, make.lab_map(*MAP))
    wbc = by_day(table, "6690-2")
    day0, day1 = wbc[0], wbc[1]
    assert sorted(wbc) == [0, 1] and by_day(table, "2019-8") == {}
    assert (day0.units, day0.num_patients_all, day0.num_patients_ever_severe) == ("u", 2, 1)
    assert day0.mean_value_all == pytest.approx(5.0)  # patients' means 3 and 7
    assert day0.stdev_value_all == pytest.approx(math.sqrt(8))
    logs = [(math.log(2.5) + math.log(4.5)) / 2, math.log(7.5)]
    assert day0.mean_log_value_all == pytest.approx(sum(logs) / 2)
    assert day0.mean_value_ever_severe == pytest.approx(3.0)
    assert day0.stdev_value_ever_severe == 0.0  # one patient
    assert day1.mean_value_all == 0.0 and day1.mean_log_value_all == pytest.approx(math.log(0.5))
    assert day1.num_patients_ever_severe == 0
    assert (day1.mean_value_ever_severe, day1.stdev_log_value_ever_severe) == (-999.0, -999.0)
    assert by_day(table, "1988-5")[0].mean_value_all == 50.0


def test_missing_scale_keeps_the_row(make):
    table = labs.labs(
        make.facts((1, "CREA", "2020-03-10 10:00", 3.0)), make.cohort((1, "2020-03-10")), make.lab_map(*MAP)
    )
    row = table.first()
    assert (row.num_patients_all, row.mean_value_all, row.stdev_value_all, row.units) == (1, None, 0.0, None)


def test_window_can_open_before_admission(make):
    facts = make.facts((1, "WBC", "2020-01-10 00:00", 3.0), (1, "WBC", "2020-01-09 23:59", 3.0))
    members = make.cohort((1, "2020-03-10"))
    table = labs.labs(facts, members, make.lab_map(*MAP), min_day=-60)
    assert rows(table, "days_since_admission", "num_patients_all") == [(-60, 1)]


def test_one_local_code_for_two_labs(make):
    lab_map = make.lab_map(("A", "X", 1.0, "u", "a"), ("B", "X", 2.0, "v", "b"))
    table = labs.labs(make.facts((1, "X", "2020-03-10 10:00", 3.0)), make.cohort((1, "2020-03-10")), lab_map)
    assert rows(table, "loinc", "units", "mean_value_all") == [("A", "u", 3.0), ("B", "v", 6.0)]
