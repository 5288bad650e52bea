import random
from datetime import date, timedelta

from conftest import rows, settings

from wardline.operators import calendar, daily


def _dates(members, as_of=date(2020, 12, 31)):
    return calendar.date_list(members, as_of)


def test_calendar_ends_today_however_long(make):
    members = make.cohort((1, "2020-01-01"), (2, "2020-02-01"))
    short = rows(_dates(members, date(2020, 1, 3)))
    assert short == [("2020-01-01",), ("2020-01-02",), ("2020-01-03",)]
    old = make.cohort((1, "2010-01-01"))
    every = rows(_dates(old))
    assert len(every) == 4018 and every[-1] == ("2020-12-31",)


def test_patients_years_apart_are_all_counted(make):
    members = make.cohort((1, "2017-01-01"), (2, "2020-11-01"))
    stays = make.admissions((1, "2017-01-01", "2017-01-02"), (2, "2020-11-01", "2020-11-30"))
    dates = _dates(members)
    counts = rows(daily.daily_counts(dates, stays, members, settings()))
    assert counts[-1][:2] == ("2020-12-31", 2) and len(counts) == 1461
    assert rows(daily.clinical_course(dates, stays, members))[0][1] == 2


def test_empty_cohort_gives_empty_tables(make):
    nobody = make.cohort()
    stays = make.admissions((1, "2020-03-10", "2020-03-12"))
    dates = _dates(nobody)
    assert rows(dates) == []
    assert rows(daily.daily_counts(dates, stays, nobody, settings())) == []
    assert rows(daily.clinical_course(dates, stays, nobody)) == []


def test_cohort_after_today_has_no_calendar(make):
    assert rows(_dates(make.cohort((1, "2021-01-05")))) == []


def test_daily_and_course_by_hand(make):
    members = make.cohort((1, "2020-03-10", "2020-03-13"), (2, "2020-03-11", None, "2020-03-12"))
    stays = make.admissions(
        (1, "2020-03-10", "2020-03-11"),
        (1, "2020-03-11", "2020-03-13"),  # overlaps: counted once
        (1, "2020-03-01", "2020-03-12"),  # before the cohort admission: ignored
        (2, "2020-03-11", "2020-03-11"),
        (2, "2020-03-14", "2020-03-20"),  # a later stay counts; cut at the end
        (3, "2020-03-10", "2020-03-20"),  # not in the cohort
    )
    dates = _dates(members, date(2020, 3, 15))
    counts = rows(daily.daily_counts(dates, stays, members, settings()))
    assert counts == [
        ("2020-03-10", 1, 0, 0, 1, 0),
        ("2020-03-11", 2, 0, 0, 2, 0),
        ("2020-03-12", 2, 0, 1, 1, 0),
        ("2020-03-13", 2, 1, 1, 1, 1),
        ("2020-03-14", 2, 1, 1, 1, 0),
        ("2020-03-15", 2, 1, 1, 1, 0),
    ]
    course = rows(daily.clinical_course(dates, stays, members))
    # Ever severe, so patient 1 counts as severe from day 0.
    assert course == [(0, 2, 1), (1, 1, 1), (2, 1, 1), (3, 2, 1), (4, 1, 0)]


def test_inaccurate_death_data(make):
    members = make.cohort((1, "2020-03-10"))
    stays = make.admissions((1, "2020-03-10", "2020-03-10"))
    counts = daily.daily_counts(
        _dates(members, date(2020, 3, 10)), stays, members, settings(death_data_accurate=False)
    )
    assert rows(counts) == [("2020-03-10", 1, 0, -999, 1, 0)]


def _brute(dates, stays, members):
    by_patient = {m[0]: m for m in members}
    counts, course = [], {}
    for day in dates:
        inside = set()
        for p, a, b in stays:
            m = by_patient.get(p)
            if m and a >= m[1] and a <= day <= b:
                inside.add(p)
        ill = {p for p in inside if by_patient[p][3] and by_patient[p][3] <= day}
        counts.append(
            (
                day.isoformat(),
                sum(m[1] <= day for m in members),
                sum(bool(m[3]) and m[3] <= day for m in members),
                sum(bool(m[4]) and m[4] <= day for m in members),
                len(inside),
                len(ill),
            )
        )
        for p in inside:
            course.setdefault((day - by_patient[p][1]).days, set()).add(p)
    table = [(k, len(v), sum(by_patient[p][2] for p in v)) for k, v in course.items()]
    return counts, sorted(table, key=lambda r: [str(x) for x in r])


def test_against_brute_force(spark, make):
    from conftest import ADMISSIONS, COHORT

    rng = random.Random(7)
    first = date(2020, 3, 1)
    members, stays = [], set()
    for p in range(40):
        a = first + timedelta(rng.randrange(40))
        s = a + timedelta(rng.randrange(20)) if rng.random() < 0.4 else None
        x = a + timedelta(rng.randrange(60)) if rng.random() < 0.3 else None
        members.append((p, a, int(s is not None), s, x))
        for _ in range(30 if p == 0 else rng.randrange(4)):
            b = a + timedelta(rng.randrange(-10, 70))
            stays.add((p, b, b + timedelta(rng.randrange(-1, 25))))
        stays.add((p, a, a + timedelta(rng.randrange(15))))
    cohort = spark.createDataFrame(members, COHORT)
    dates = _dates(cohort, date(2020, 5, 20))
    table = spark.createDataFrame(sorted(stays), ADMISSIONS)
    days = [date.fromisoformat(r[0]) for r in rows(dates)]
    counts, course = _brute(days, stays, members)
    assert rows(daily.daily_counts(dates, table, cohort, settings())) == counts
    assert rows(daily.clinical_course(dates, table, cohort)) == course
