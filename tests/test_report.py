"""Totals over the test tables, written down independently, and invariants of the report."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardline.operators.tables import COURSE, DAILY, DEMOGRAPHICS, LABS, MEDICATIONS, TABLES
from wardline.plans.report import Report, raw_table

# Totals measured over the test tables (FIXTURES.md).
TOTALS = {
    "/root/testdata/sf0.001": dict(
        index=125, admissions=447, cohort=16, severe=9, dead=4,
        daily=[4135, 1941, 547, 603, 63], course=(190, 603, 214), demo=(85, 244, 136), hispanic=31,
        meds=[28, 26, 16, 17], wbc=(19, 455.5, 7.778175, 56.528837),
    ),
    "/root/testdata/sf0.01": dict(
        index=1151, admissions=4096, cohort=140, severe=71, dead=18,
        daily=[35627, 14588, 2474, 3643, 609], course=(245, 3643, 1857), demo=(219, 1984, 1028),
        hispanic=231, meds=[295, 217, 157, 127], wbc=(108, 2657.8, 548.646521, 325.52526),
    ),
}


def sums(df, columns):
    return list(df.agg(*[F.sum(c) for c in columns]).first())


@pytest.mark.parametrize("sf_dir", sorted(TOTALS))
def test_totals(spark, sf_dir):
    check_totals(spark, sf_dir)


def test_totals_when_nothing_fits(spark, no_broadcast):
    check_totals(spark, SMALL)


def check_totals(spark, sf_dir):
    want = TOTALS[sf_dir]
    s = entry.study(spark, sf_dir)
    assert s.index_events.count() == want["index"]
    assert s.admissions.count() == want["admissions"]
    assert s.cohort.count() == want["cohort"]
    assert s.cohort.agg(F.sum("severe"), F.count("death_date")).first()[:] == (want["severe"], want["dead"])
    daily = raw_table(s, DAILY)
    assert daily.count() == 306 and sums(daily, DAILY.counts) == want["daily"]
    course = raw_table(s, COURSE)
    assert (course.count(), *sums(course, COURSE.counts)) == want["course"]
    demo = raw_table(s, DEMOGRAPHICS)
    assert (demo.count(), *sums(demo, DEMOGRAPHICS.counts)) == want["demo"]
    hispanic = demo.filter("sex = 'all' and age_group = 'all' and race = 'hispanic_latino'").first()
    assert hispanic.num_patients_all == want["hispanic"]
    assert sums(raw_table(s, MEDICATIONS), MEDICATIONS.counts) == want["meds"]
    wbc = raw_table(s, LABS).filter("loinc = '6690-2'")
    values = sums(wbc, ["mean_value_all", "stdev_value_all", "mean_log_value_all"])
    assert (wbc.count(), *[round(v, 6) for v in values]) == pytest.approx(want["wbc"])


def test_invariants(spark):
    s = entry.study(spark, SMALL)
    days = [r[1:] for r in raw_table(s, DAILY).orderBy("calendar_date").collect()]
    for earlier, later in zip(days, days[1:]):
        assert all(a <= b for a, b in zip(earlier[:3], later[:3]))
    for everyone, severe, dead, inside, inside_severe in days:
        assert max(severe, dead, inside) <= everyone and inside_severe <= inside
    demo = raw_table(s, DEMOGRAPHICS).collect()
    total = next(r.num_patients_all for r in demo if r[:3] == ("all", "all", "all"))
    assert sum(r.num_patients_all for r in demo if r[0] != "all" and r[1:3] == ("all", "all")) == total


def test_protected_report_hides_small_counts(spark):
    report = Report(entry.study(spark, SMALL, obfuscation_blur=2, obfuscation_demographics=True))
    tables = report.tables()
    assert list(tables) == [spec.name for spec in TABLES]
    for spec in TABLES:
        df = tables[spec.name]
        assert df.columns == spec.with_site
        for c in spec.counts:
            assert df.filter(F.col(c).between(-98, 9)).count() == 0
    assert report.table(DAILY) is report.table(DAILY)
