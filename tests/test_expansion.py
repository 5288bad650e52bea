import random

from conftest import rows

from wardline.operators import expansion

TREE = [
    ("\\A\\", None),
    ("\\A\\LAB_1\\", "L1"),
    ("\\A\\LAB_1\\X\\", "L2"),
    ("\\A\\LAB_1\\X\\Y\\", "L3"),
    ("\\A\\LABX1\\X\\", "TRAP"),
    ("\\A\\LAB_1\\Z\\", None),
    ("\\M\\D\\", "D1"),
    ("\\M\\D\\E\\", "D2"),
    ("\\M\\D\\F\\", "D3"),
    ("\\N\\D\\", "D1"),
    ("\\N\\D\\G\\", "D4"),
]


def test_codes_under_path(make):
    concepts = make.concepts(*TREE, ("\\A\\LAB_1\\W\\", "L2"))
    existing = make.code_map(("covidpos", "L1"), ("other", "L3"))
    found = expansion.codes_under_path(concepts, "\\A\\LAB_1\\", existing)
    assert rows(found) == [("covidpos", "L2"), ("covidpos", "L3")]


def test_lab_map_takes_all_descendants(make):
    lab_map = make.lab_map(("6690-2", "L1", 2.0, "u", "w"), ("6690-2", "L3", 1.0, "v", "x"))
    found = expansion.expand_lab_map(lab_map, make.concepts(*TREE))
    assert rows(found) == [("6690-2", "L2", 2.0, "u", "w")]


def test_med_map_takes_used_descendants_under_the_root(make):
    med_map = make.med_map(("ACEI", "ATC", "D1"))
    facts = make.facts((1, "D2", "2020-01-01 00:00"), (1, "D4", "2020-01-01 00:00"))
    found = expansion.expand_med_map(med_map, make.concepts(*TREE), facts, "\\M\\")
    assert rows(found) == [("ACEI", "Expand", "D2")]


def test_against_plain_prefix_match(make):
    """Random paths, some of which do not end in a separator."""
    rng = random.Random(3)
    paths = set()
    while len(paths) < 60:
        path = "\\" + "\\".join(rng.choice(["A", "AB", "A_", "%"]) for _ in range(rng.randrange(1, 5)))
        paths.add(path + rng.choice(["\\", ""]))
    tree = [(p, f"C{i}") for i, p in enumerate(sorted(paths))]
    mapped = rng.sample(tree, 12)
    lab_map = [(f"LOINC{i % 5}", code, 1.0, "u", "n") for i, (_, code) in enumerate(mapped)]
    have = {(loinc, code) for loinc, code, *_ in lab_map}
    path_of = {code: path for path, code in tree}
    expected = sorted(
        {
            (loinc, below, 1.0, "u", "n")
            for loinc, code, *_ in lab_map
            for path, below in tree
            if path.startswith(path_of[code]) and (loinc, below) not in have
        }
    )
    found = expansion.expand_lab_map(make.lab_map(*lab_map), make.concepts(*tree))
    assert rows(found) == expected
