import random
from datetime import date, timedelta

import pytest
from conftest import SMALL, d, rows

import __spark_entry__ as entry
from wardline.operators import calendar, daily, intervals

STAYS = "id int, start date, end date"


def plain(stays, days):
    return sorted((i, s, e, x) for i, s, e in stays for x in days if s and e and s <= x <= e)


def met(df):
    return sorted((r.id, r.start, r.end, r.d) for r in df.collect())


@pytest.mark.parametrize("slab", [1, 7, 32, 1000])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_pairs_equal_every_day_against_every_interval(spark, slab, threshold):
    rng, first = random.Random(slab), date(1969, 11, 20)  # across the epoch's beginning
    stays = []
    for k in range(150):
        start = first + timedelta(days=rng.randrange(120))
        stays.append((k, start, start + timedelta(days=rng.choice([0, 1, 5, 200, 3000, -1]))))
    stays += [(900, None, first), (901, first, None), (902, None, None)]
    days = [first + timedelta(days=k) for k in range(0, 140, 3)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        table = spark.createDataFrame([(x,) for x in [*days, None]], "d date")
        found = intervals.covered_days(spark.createDataFrame(stays, STAYS), table, ["id"], slab)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert met(found) == plain(stays, days)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_long_interval_is_kept_once_per_slab(spark):
    stays = spark.createDataFrame([(1, d("2000-01-01"), d("2019-12-31"))], STAYS)
    days = spark.createDataFrame([(d("2010-06-01"),)], "d date")
    found = intervals.covered_days(stays, days, ["id"], 32)
    assert met(found) == [(1, d("2000-01-01"), d("2019-12-31"), d("2010-06-01"))]
    cut = spark.sql("SELECT size(sequence(CAST(floor(unix_date(date'2000-01-01') / 32) AS INT), CAST(floor(unix_date(date'2019-12-31') / 32) AS INT)))")
    assert cut.first()[0] == 229 < 7305


def test_inpatients_by_hand(make):
    members = make.cohort((1, "2020-03-10", "2020-03-13"), (2, "2020-03-11"), (4, "2020-03-12"))
    stays = make.admissions(
        (1, "2020-03-10", "2020-03-11"), (1, "2020-03-11", "2020-03-13"), (1, "2020-03-01", "2020-03-12"),
        (2, "2020-03-14", "2020-03-20"), (3, "2020-03-10", "2020-03-20"),
    )
    dates = calendar.date_list(members, date(2020, 3, 15))
    assert rows(intervals.inpatients_by_date(dates, stays, members)) == [
        ("2020-03-10", 1, 0), ("2020-03-11", 1, 0), ("2020-03-12", 1, 0), ("2020-03-13", 1, 1),
        ("2020-03-14", 2, 0), ("2020-03-15", 2, 0),
    ]
    nobody = make.cohort()
    assert rows(intervals.inpatients_by_date(calendar.date_list(nobody, date(2020, 3, 15)), stays, nobody)) == []


def test_counts_equal_daily_counts(spark):
    with entry.study(spark, SMALL) as s:
        listed = intervals.inpatients_by_date(s.dates, s.admissions, s.severe_cohort)
        per_day = {}
        for r in listed.collect():
            n, ill = per_day.get(r.calendar_date, (0, 0))
            per_day[r.calendar_date] = n + 1, ill + r.severe
        counts = daily.daily_counts(s.dates, s.admissions, s.severe_cohort, s.cfg).collect()
        assert per_day and all(per_day.get(r[0], (0, 0)) == (r[4], r[5]) for r in counts)
