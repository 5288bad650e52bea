import pytest
from conftest import rows, settings

from wardline.operators import death, severity

LABS = [("2019-8", "GAS", None, None, None), ("6690-2", "WBC", 1.0, "u", "w")]
MEDS = [("SIANES", "ATC", "SED"), ("ACEI", "ATC", "PILL")]


@pytest.mark.parametrize(
    "concept, severe",
    [
        ("GAS", True),
        ("WBC", False),
        ("SED", True),
        ("PILL", False),
        ("DIAG|ICD10:J80", True),
        ("DIAG|ICD10:J80.1", False),
        ("DIAG|ICD9:518.82", True),
        ("DIAG|ICD10:J95.851", True),
        ("DIAG|ICD9:997.31", True),
        ("PROC|ICD10:0BH17EZ", True),
        ("PROC|ICD9:96.04", True),
        ("PROC|ICD10:5A0935Z", True),
        ("PROC|ICD10:5A094", True),
        ("PROC|ICD10:5A0955Z", True),
        ("PROC|ICD10:5A0965Z", False),
        ("PROC|ICD10:5A1955Z", False),
        ("XPROC|ICD10:5A0935Z", False),
        ("PROC_ICD10:5A0935Z", False),
        ("PROC|ICD9:96.70", True),
        ("PROC|ICD9:96.72", True),
        ("PROC|ICD9:96.73", False),
        ("PROC|ICD9:96.70x", False),
    ],
)
def test_severe_codes(spark, concept, severe):
    from pyspark.sql import functions as F

    from wardline.functions.clinical import severe_by_code

    mapped = concept in ("GAS", "SED")
    one = spark.range(1).select(severe_by_code(F.lit(concept), settings()).alias("s")).first().s
    assert (one or mapped) == severe


def test_severe_events_first_day_since_admission(make):
    facts = make.facts(
        (1, "GAS", "2020-03-09 23:59"),  # before admission
        (1, "SED", "2020-03-12 08:00"),
        (1, "GAS", "2020-03-11 08:00"),
        (2, "DIAG|ICD10:J80", "2020-03-10 00:00"),  # midnight of the admission day
        (3, "WBC", "2020-03-12 00:00"),
        (4, "GAS", "2020-03-12 00:00"),  # not in the cohort
    )
    members = make.cohort((1, "2020-03-10"), (2, "2020-03-10"), (3, "2020-03-10"))
    found = severity.severe_events(facts, members, make.lab_map(*LABS), make.med_map(*MEDS), settings())
    assert rows(found) == [(1, "2020-03-11"), (2, "2020-03-10")]
    flagged = severity.flag_severe(members, found)
    assert rows(flagged, "patient_num", "severe", "severe_date") == [
        (1, 1, "2020-03-11"),
        (2, 1, "2020-03-10"),
        (3, 0, None),
    ]


def _patient(number, death_date=None, status="N"):
    from conftest import d

    return {"patient_num": number, "death_date": d(death_date), "vital_status_cd": status}


def test_death_dates(make):
    members = make.cohort(
        (1, "2020-03-10"),
        (2, "2020-03-10", "2020-03-12"),
        (3, "2020-03-10"),
        (4, "2020-03-10"),
        (5, "2020-03-10"),
        (6, "2020-03-10"),
    )
    people = make.patients(
        _patient(1, "2020-04-01"),
        _patient(2, None, "Y"),  # severe date stands in
        _patient(3, None, "Y"),  # admission date stands in
        _patient(4, "2020-03-01"),  # before admission: moved to it
        _patient(5),
    )
    found = death.death_dates(members, people)
    assert rows(found, "patient_num", "death_date") == [
        (1, "2020-04-01"),
        (2, "2020-03-12"),
        (3, "2020-03-10"),
        (4, "2020-03-10"),
        (5, None),
        (6, None),
    ]
    assert rows(death.death_dates(members, people, accurate=False)) == rows(members)


def test_death_moves_to_last_fact(make):
    members = make.cohort(
        (1, "2020-03-10", None, "2020-03-20"),
        (2, "2020-03-10", None, "2020-03-20"),
        (3, "2020-03-10"),
        (4, "2020-03-10", None, "2020-03-20"),
    )
    facts = make.facts(
        (1, "A", "2020-03-25 09:00"),
        (1, "A", "2020-03-22 09:00"),
        (2, "A", "2020-03-20 09:00"),  # later the same day: date stays
        (3, "A", "2020-03-25 09:00"),
        (4, "A", "2020-03-01 09:00"),
    )
    assert rows(death.correct_death_by_last_fact(members, facts), "patient_num", "death_date") == [
        (1, "2020-03-25"),
        (2, "2020-03-20"),
        (3, None),
        (4, "2020-03-20"),
    ]
