from conftest import rows

from wardline.operators import checks
from wardline.operators.tables import TABLES


def test_violations(make):
    lab_map = make.lab_map(
        ("A", "X", 1.0, "u", "n"),
        ("A", "X", 2.0, "u", "n"),
        ("B", None, 1.0, "u" * 21, "n"),
        ("B" * 21, "Y", 1.0, "u", "n"),
    )
    found = checks.check_rules(lab_map, "lab_map", checks.MAP_RULES["lab_map"])
    assert rows(found) == [
        ("lab_map", "max_length(20)", "lab_units", "u" * 21, 1),
        ("lab_map", "max_length(20)", "loinc", "B" * 21, 1),
        ("lab_map", "not_null", "local_lab_code", None, 1),
        ("lab_map", "unique", "loinc,local_lab_code", "A|X", 2),
    ]


def test_site_id_rule(spark):
    names = ["Good1", "1bad", "has space", "x" * 21, "under_score"]
    df = spark.createDataFrame([(n,) for n in names], "siteid string")
    found = checks.check_rules(df, "t", [checks.site_id()])
    assert {r.value for r in found.collect()} == set(names[1:])


def test_every_table_has_its_key(make):
    assert set(checks.OUTPUT_RULES) == {t.name for t in TABLES}
    for spec in TABLES:
        assert checks.unique(*spec.key) in checks.OUTPUT_RULES[spec.name]


def test_clean_tables_give_no_rows(make):
    code_map = make.code_map(("male", "M"), ("male", "Male"))
    assert rows(checks.check_rules(code_map, "code_map", checks.MAP_RULES["code_map"])) == []


def test_all_rules_of_a_table_share_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "a", "xxx"), (2, "a", "x")], "k long, g string, v string")
    rules = [checks.unique("k"), checks.unique("k", "g"), checks.unique("g", "v"), checks.not_null("v"), checks.max_length("v", 2)]
    found = checks.check_rules(df, "t", rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan") == 1
    assert rows(found, "rule", "column_names", "value", "n_rows") == [
        ("max_length(2)", "v", "xxx", 1), ("not_null", "v", None, 1), ("unique", "g,v", "a|x", 2),
        ("unique", "k", "1", 2), ("unique", "k", "2", 2), ("unique", "k,g", "2|a", 2),
    ]
    assert rows(checks.check_rules(df, "t", [])) == []


def test_keys_that_look_alike_are_told_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("null", "x"), (None, "x")], "x string, y string")
    assert rows(checks.check_rules(df, "t", [checks.unique("x", "y")])) == []


def test_null_parts_of_a_key_are_shown(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("a", None), ("a", None)], "x string, y string")
    found = checks.check_rules(df, "t", [checks.unique("x", "y")])
    assert sorted(r["value"] for r in found.collect()) == ["a|null", "null|a"]
