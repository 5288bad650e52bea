import random
import re
from datetime import timedelta

import pytest
from conftest import SMALL, d, rows, settings

import __spark_entry__ as entry
from wardline.operators import cohort, death, severity
from wardline.plans.refresh import CohortState
from wardline.plans.study import Study
from wardline.sources.maps import Maps
from wardline.sources.readers import Sources


def maps_of(make):
    return Maps(
        make.code_map(("covidpos", "POS"), ("inpatient", "I")),
        make.lab_map(("2019-8", "GAS", 1.0, "mmHg", "g")),
        make.med_map(("SIANES", "ATC", "SED")),
    )


def story(seed, n=40):
    """Facts and visits of ``n`` patients, in random order."""
    rng = random.Random(seed)
    day = lambda: (d("2020-01-01") + timedelta(days=rng.randrange(150))).isoformat()
    facts = [(rng.randrange(n), rng.choice(["POS", "GAS", "SED", "OTHER", "DIAG|ICD10:J80"]), day()) for _ in range(6 * n)]
    visits = [(rng.randrange(n), day(), None, rng.choice("IO")) for _ in range(3 * n)]
    return facts, visits


def whole(make, facts, visits, patients, maps, cfg):
    s = Study(Sources(make.facts(*facts), make.visits(*visits), patients, make.concepts()), maps, cfg)
    return rows(s.cohort)


@pytest.mark.parametrize("seed", [1, 2])
def test_folds_in_any_order_equal_one_run(spark, make, seed):
    maps, cfg = maps_of(make), settings()
    facts, visits = story(seed)
    patients = make.patients(*[dict(patient_num=p, death_date=d("2020-03-01"), vital_status_cd="N") for p in range(0, 40, 2)])
    facts += [(0, "POS", "2020-02-03"), (2, "POS", "2020-02-03"), (2, "SED", "2020-06-03")]
    visits += [(0, "2020-02-03", None, "I"), (2, "2020-02-03", None, "I")]
    want = whole(make, facts, visits, patients, maps, cfg)
    state = CohortState(spark, parts=5)
    for k in (2, 0, 1, 0):  # the second delivery comes twice
        state.fold(make.facts(*facts[k::3]), make.visits(*visits[k::3]), maps, cfg)
    assert rows(state.cohort(patients, cfg), "patient_num", "admission_date", "severe", "severe_date", "death_date") == want
    assert any(r[2] for r in want) and any(r[4] for r in want)


def test_repeating_a_delivery_changes_nothing(spark, make):
    maps, cfg = maps_of(make), settings()
    facts, visits = story(3)
    state = CohortState(spark, parts=4)
    state.fold(make.facts(*facts[::2]), make.visits(*visits[::2]), maps, cfg)
    state.fold(make.facts(*facts[1::2]), make.visits(*visits[1::2]), maps, cfg)
    before = sorted(map(str, state.rows().collect()))
    state.fold(make.facts(*facts[1::2]), make.visits(*visits[1::2]), maps, cfg)
    state.fold(make.facts(), make.visits(), maps, cfg)
    assert sorted(map(str, state.rows().collect())) == before
    assert state.rows().select("patient_num").distinct().count() == state.rows().count()


def test_a_late_fact_moves_an_admission(spark, make):
    maps, cfg = maps_of(make), settings()
    state, nobody = CohortState(spark, parts=2), make.patients()
    visits = make.visits((1, "2020-02-10", None, "I"), (1, "2020-03-01", None, "I"))
    state.fold(make.facts((1, "POS", "2020-03-02"), (1, "SED", "2020-02-12")), visits, maps, cfg)
    assert rows(state.cohort(nobody, cfg)) == [(1, "2020-03-01", 0, None, None)]
    state.fold(make.facts((1, "POS", "2020-02-09")), make.visits(), maps, cfg)
    assert rows(state.cohort(nobody, cfg)) == [(1, "2020-02-10", 1, "2020-02-12", None)]


def test_old_facts_are_not_read_and_only_touched_parts(spark, make):
    maps, cfg = maps_of(make), settings()
    state = CohortState(spark, parts=16)
    state.fold(make.facts(*[(p, "POS", "2020-03-02") for p in range(200)]), make.visits(), maps, cfg)

    def files():
        return {r[0] for r in state.rows().select("_metadata.file_path").distinct().collect()}

    before = files()
    new = spark.createDataFrame([(7, "SED", None, None, None)], make.facts().schema)
    state.fold(new, make.visits(), maps, cfg)
    assert len(before - files()) == 1 == len(files() - before)
    found = state.cohort(make.patients(), cfg)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*?Location: \w+\(\d+ paths\)\[(\S+?)[,\]]", found)
    assert scans and all("/cohort-state-" in s for s in scans)


def test_changed_maps_are_refused(spark, make):
    maps, cfg = maps_of(make), settings()
    state = CohortState(spark, parts=2)
    state.fold(make.facts((1, "POS", "2020-03-02")), make.visits(), maps, cfg)
    other = Maps(make.code_map(("covidpos", "POS2"), ("inpatient", "I")), maps.lab_map, maps.med_map)
    with pytest.raises(ValueError, match="have changed"):
        state.fold(make.facts((2, "POS2", "2020-03-02")), make.visits(), other, cfg)
    with pytest.raises(ValueError, match="have changed"):
        state.fold(make.facts(), make.visits(), maps, settings(code_prefix_icd10cm="X:"))
    again = CohortState(spark, state.path, parts=9)  # the folder's own number of parts holds
    again.fold(make.facts((3, "POS", "2020-03-02")), make.visits(), maps, cfg)
    assert {r.patient_num for r in again.rows().collect()} == {1, 3}


def test_deaths_that_are_not_corrected_or_not_known(spark, make):
    maps = maps_of(make)
    facts, visits = story(4)
    patients = make.patients(*[dict(patient_num=p, death_date=d("2020-03-01")) for p in range(20)])
    for cfg in (settings(correct_death_by_last_fact=False), settings(death_data_accurate=False)):
        state = CohortState(spark, parts=3)
        state.fold(make.facts(*facts), make.visits(*visits), maps, cfg)
        assert rows(state.cohort(patients, cfg)) == whole(make, facts, visits, patients, maps, cfg)
