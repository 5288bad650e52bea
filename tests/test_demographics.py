import pytest
from conftest import d, rows, settings

from wardline.operators import demographics
from wardline.operators.demographics import DIMENSIONS, known_attributes

CODES = [
    ("male", "M"),
    ("male", "Male"),
    ("female", "F"),
    ("white", "W"),
    ("asian", "A"),
    ("hispanic_latino", "HISP"),
]


def person(number, sex=None, age=None, race=None, birth=None):
    return {
        "patient_num": number,
        "sex_cd": sex,
        "age_in_years_num": age,
        "race_cd": race,
        "birth_date": d(birth),
    }


@pytest.fixture
def sample(make):
    members = make.cohort((1, "2020-03-10", "2020-03-11"), (2, "2020-03-10"), (3, "2020-03-10"))
    people = make.patients(
        person(1, "M", 30, "W"), person(2, "U", None, "Q"), person(9, "F", 3, "A")
    )
    facts = make.facts(
        (1, "HISP", "2001-01-01 00:00"),
        (1, "HISP", "2020-03-10 00:00"),
        (9, "HISP", "2020-03-10 00:00"),
    )
    return members, people, facts, make.code_map(*CODES)


def test_attribute_rows_with_fill(sample):
    found = demographics.demographics_attrs(*sample, settings())
    assert rows(found, "patient_num", *DIMENSIONS) == sorted(
        [
            (1, "male", None, None),
            (1, None, "26to49", None),
            (1, None, None, "white"),
            (1, None, None, "hispanic_latino"),
            (1, None, None, "hispanic_latino"),
            (2, "other", None, None),
            (2, None, "other", None),
            (2, None, None, "other"),
            (3, "other", None, None),
            (3, None, "other", None),
            (3, None, None, "other"),
        ],
        key=lambda r: [str(x) for x in r],
    )


@pytest.mark.parametrize("counted", [True, False])
def test_repeated_race_rows_count_twice_unless_deduped(sample, counted):
    def count(cfg):
        attrs = known_attributes(*sample, cfg, counted=counted)
        table = demographics.demographics(sample[0], attrs, cfg)
        return {r[:3]: r[3:] for r in rows(table, *DIMENSIONS, "num_patients_all", "num_patients_ever_severe")}

    faithful, single = count(settings()), count(settings(dedupe_race=True))
    assert faithful["all", "all", "hispanic_latino"] == (2, 2)
    assert faithful["male", "26to49", "hispanic_latino"] == (2, 2)
    assert single["all", "all", "hispanic_latino"] == (1, 1)
    for table in (faithful, single):
        assert table["all", "all", "all"] == (3, 1)
        assert table["other", "all", "all"] == (2, 0)
        assert table["male", "all", "white"] == (1, 1)


def test_filled_and_unfilled_attributes_agree(sample):
    filled = demographics.demographics_attrs(*sample, settings())
    known = known_attributes(*sample, settings(), counted=True)
    assert rows(demographics.demographics(sample[0], filled, settings())) == rows(
        demographics.demographics(sample[0], known, settings())
    )


def test_without_race_every_count_is_blank(sample):
    cfg = settings(include_race=False)
    table = demographics.demographics(sample[0], known_attributes(*sample, cfg), cfg)
    found = rows(table)
    assert {r[3:] for r in found} == {(-999, -999)}
    assert {r[2] for r in found} == {"all", "other"}


def test_race_flags_choose_the_source(make):
    members = make.cohort((1, "2020-03-10"))
    people = make.patients(person(1, "M", 30, "HISP"))
    facts = make.facts((1, "A", "2020-03-10 00:00"))
    codes = make.code_map(*CODES)

    def races(**flags):
        known = known_attributes(members, people, facts, codes, settings(**flags))
        return [r[0] for r in rows(known, "race") if r[0]]

    assert races(race_in_fact_table=False, hispanic_in_fact_table=True) == []
    assert races(race_in_fact_table=True, hispanic_in_fact_table=True) == ["asian"]
    assert races(race_in_fact_table=False, hispanic_in_fact_table=False) == ["hispanic_latino"]
    assert races(race_in_fact_table=True, hispanic_in_fact_table=False) == ["asian", "hispanic_latino"]


@pytest.mark.parametrize(
    "age, band",
    [(0, "00to02"), (2, "00to02"), (3, "03to05"), (6, "06to11"), (12, "12to17"), (18, "18to25"),
     (25, "18to25"), (26, "26to49"), (50, "50to69"), (79, "70to79"), (80, "80plus"), (None, "other"),
     (-1, "other")],
)
def test_age_bands(spark, age, band):
    from pyspark.sql import functions as F

    from wardline.functions.clinical import age_band

    assert spark.range(1).select(age_band(F.lit(age).cast("int")).alias("b")).first().b == band


def test_age_from_birth_date(make):
    members = make.cohort((1, "2020-03-10"), (2, "2020-03-10"))
    people = make.patients(person(1, age=80, birth="2017-12-31"), person(2, age=80, birth="2018-01-01"))
    known = known_attributes(
        members, people, make.facts(), make.code_map(*CODES), settings(age_source="birth_date")
    )
    assert [r for r in rows(known, "patient_num", "age_group") if r[1]] == [(1, "03to05"), (2, "00to02")]
