from datetime import date

from conftest import rows

from wardline.operators import cohort

CODES = [("covidpos", "POS"), ("inpatient", "I"), ("inpatient", "IN")]


def test_index_event_is_first_mapped_day(make):
    facts = make.facts(
        (1, "POS", "2020-03-05 23:00"),
        (1, "POS", "2020-03-02 10:00"),
        (1, "OTHER", "2020-01-01 00:00"),
        (2, "OTHER", "2020-01-01 00:00"),
        (3, "pos", "2020-01-01 00:00"),
    )
    codes = make.code_map(*CODES, ("covidpos", "POS2"))
    assert rows(cohort.index_events(facts, codes)) == [(1, "2020-03-02")]


def test_a_code_mapped_twice_changes_nothing(make):
    facts = make.facts((1, "POS", "2020-03-02 10:00"))
    codes = make.code_map(("covidpos", "POS"), ("covidpos", "POS"), ("white", "POS"))
    assert rows(cohort.index_events(facts, codes)) == [(1, "2020-03-02")]


def test_index_event_by_result_text(make):
    facts = make.facts(
        (1, "T1", "2020-03-05 10:00", None, "PoSiTiVe"),
        (1, "T1", "2020-03-01 10:00", None, "negative"),
        (2, "T9", "2020-03-01 10:00", None, "positive"),
        (3, "T2", "2020-03-04 10:00", None, None),
        (4, "T2", "2020-03-04 10:00", None, "positive"),
    )
    found = cohort.index_events_by_result(facts, ["T1", "T2"])
    assert rows(found) == [(1, "2020-03-05"), (4, "2020-03-04")]


def test_admissions_lookback_edge_open_stay_and_distinct(make):
    visits = make.visits(
        (1, "2020-03-03 00:00", "2020-03-04 10:00", "I"),  # index - 7 at midnight: in
        (1, "2020-03-02 23:59", "2020-03-04 10:00", "I"),  # index - 8: out
        (1, "2020-03-03 09:00", "2020-03-04 23:00", "IN"),  # same days again: one row
        (1, "2020-05-01 09:00", None, "I"),  # open: closed by as_of
        (1, "2020-04-01 09:00", "2020-04-02 23:00", "O"),  # not inpatient
        (2, "2020-04-01 09:00", "2020-04-02 23:00", "I"),  # never positive
    )
    found = cohort.admissions(
        visits, make.positives((1, "2020-03-10")), make.code_map(*CODES), date(2020, 12, 31)
    )
    assert rows(found) == [
        (1, "2020-03-03", "2020-03-04"),
        (1, "2020-05-01", "2020-12-31"),
    ]


def test_several_index_days_per_patient(make):
    positives = make.positives((1, "2020-03-10"), (1, "2020-05-10"))
    visits = make.visits((1, "2020-03-03 00:00", "2020-03-04 10:00", "I"))
    stays = cohort.admissions(visits, positives, make.code_map(*CODES), date(2020, 12, 31))
    assert rows(stays) == [(1, "2020-03-03", "2020-03-04")]
    late = make.admissions((1, "2020-05-24", "2020-05-25"))
    assert rows(cohort.cohort(positives, late), "admission_date") == [("2020-05-24",)]


def test_cohort_window_edge(make):
    positives = make.positives((1, "2020-03-10"), (2, "2020-03-10"), (3, "2020-03-10"))
    stays = make.admissions(
        (1, "2020-03-24", "2020-03-25"),  # day 14: in
        (2, "2020-03-25", "2020-03-25"),  # day 15: out
        (3, "2020-03-20", "2020-03-25"),
        (3, "2020-03-08", "2020-03-09"),  # the earliest counts
    )
    assert rows(cohort.cohort(positives, stays)) == [
        (1, "2020-03-24", 0, None, None),
        (3, "2020-03-08", 0, None, None),
    ]
