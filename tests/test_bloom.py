import random
import re

import pytest
from pyspark.sql import functions as F

from wardline.operators import bloom, scope
from wardline.storage import materialize


def written(spark, ids, kind="long"):
    return materialize(spark.createDataFrame([(i,) for i in ids], f"patient_num {kind}"), "keys")


def passed(found, rows):
    return {r[0] for r in rows.filter(found.may_hold(F.col("patient_num"))).collect()}


@pytest.mark.parametrize("n", [1, 60, 5_000])
def test_holds_every_key_and_few_others(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-(10**12), 10**12), n)
    found = bloom.bloom_filter(written(spark, ids), "patient_num")
    others = set(rng.sample(range(10**13, 10**14), 20_000))
    assert passed(found, written(spark, ids)) == set(ids)
    wrong = passed(found, written(spark, sorted(others)))
    assert len(wrong) <= 2 * bloom.FALSE_POSITIVES * len(others)


def test_text_keys_and_no_keys(spark):
    found = bloom.bloom_filter(written(spark, ["p1", "é", ""], "string"), "patient_num")
    assert passed(found, written(spark, ["p1", "é", "", "p2", "p3"], "string")) >= {"p1", "é", ""}
    assert passed(bloom.bloom_filter(written(spark, []), "patient_num"), written(spark, [1, 2])) == set()


def test_shape_is_bounded():
    bits, hashes = bloom.shape(10_000, 1 << 26)
    assert 9.5 < bits / 10_000 < 9.7 and hashes == 7
    bits, hashes = bloom.shape(10_000_000, 1 << 26)
    assert bits <= (1 << 26) + 64 and hashes == 5
    assert bloom.shape(100_000_000, 1 << 26) is None
    assert bloom.shape(0, 1 << 26)[0] >= 64


def test_words_are_added_up_in_tasks(spark):
    found = bloom.bloom_filter(written(spark, range(1000)), "patient_num")
    plan = found.words._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan[plan.rindex("Exchange hashpartitioning(word"):]


def test_facts_of_others_are_dropped_before_the_shuffle(spark, no_broadcast):
    """Rows that reach the exchange: the cohort's share, plus the false positives."""
    facts = materialize(
        spark.range(40_000).selectExpr("id % 2000 AS patient_num", "'C' AS concept_cd", "id AS start_date"), "facts"
    )
    members = written(spark, range(0, 2000, 40))
    kept = scope.facts_of(facts, members)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    side = plan[: plan.index("FileScan parquet")]
    assert side.index("Exchange hashpartitioning") < side.rindex("Filter") and "getbit" in side[side.rindex("Filter"):]
    assert kept.count() == 1000 == kept.filter("patient_num % 40 = 0").count()
    held = bloom.bloom_filter(members, "patient_num")
    near = facts.filter(held.may_hold(F.col("patient_num"))).count()
    assert 1000 <= near <= 1000 + 3 * bloom.FALSE_POSITIVES * 40_000


def test_too_many_keys_join_without_a_filter(spark, no_broadcast):
    spark.conf.set(bloom.MOST_BITS_CONF, "64")
    try:
        facts = spark.range(3000).selectExpr("id AS patient_num", "'C' AS concept_cd", "id AS start_date")
        kept = scope.facts_of(facts, written(spark, range(500)))
        assert not re.search("getbit", kept._jdf.queryExecution().executedPlan().toString())
        assert kept.count() == 500
    finally:
        spark.conf.unset(bloom.MOST_BITS_CONF)
