from conftest import rows, settings

from wardline.operators import history

DX = "DIAG|ICD10:I10"


def test_windows(make):
    """Admission 2020-03-20: before ends at midnight of 03-05, starts at midnight of 2019-03-21."""
    members = make.cohort(*[(p, "2020-03-20", "2020-03-21" if p % 2 else None) for p in range(1, 8)])
    facts = make.facts(
        (1, "DIAG|ICD10:A00.1", "2020-03-05 10:00"),  # in the gap
        (2, "DIAG|ICD10:B00.1", "2020-03-05 00:00"),  # before
        (3, "DIAG|ICD10:C00.1", "2020-03-20 23:00"),  # since
        (4, "DIAG|ICD10:D00.1", "2019-03-21 00:00"),  # first moment of the year
        (5, "DIAG|ICD10:E00.1", "2019-03-20 23:59"),  # too old
        (6, "DIAG|ICD10:F00.1", "2020-03-15 00:00"),  # gap
        (7, "DIAG|ICD10:G00.1", "2020-03-01 00:00"),  # before and since
        (7, "DIAG|ICD10:G00.9", "2020-03-25 00:00"),
        (7, "DIAG|ICD10:G00.9", "2020-03-26 00:00"),
        (8, "DIAG|ICD10:H00.1", "2020-03-25 00:00"),  # not in the cohort
    )
    assert rows(history.diagnoses(facts, members, settings())) == [
        ("A00", 10, 0, 0, 0, 0),
        ("B00", 10, 1, 0, 0, 0),
        ("C00", 10, 0, 1, 0, 1),
        ("D00", 10, 1, 0, 0, 0),
        ("F00", 10, 0, 0, 0, 0),
        ("G00", 10, 1, 1, 1, 1),
    ]


def test_versions_and_prefixes(make):
    members = make.cohort((1, "2020-03-20"))
    facts = make.facts(
        (1, "DIAG|ICD9:401.9", "2020-03-21 00:00"),
        (1, "DIAG|ICD10:I10", "2020-03-21 00:00"),
        (1, "DIAG|ICD10:I1", "2020-03-21 00:00"),
        (1, "diag|icd10:I10", "2020-03-21 00:00"),
    )

    def codes(**prefixes):
        table = history.diagnoses(facts, members, settings(**prefixes))
        return rows(table, "icd_code_3chars", "icd_version")

    assert codes() == [("401", 9), ("I1", 10), ("I10", 10)]
    assert codes(code_prefix_icd9cm="") == [("I1", 10), ("I10", 10)]
    assert codes(code_prefix_icd9cm="", code_prefix_icd10cm="") == []
    # One prefix may be the start of the other: such a fact counts under both versions.
    assert codes(code_prefix_icd9cm="DIAG|ICD", code_prefix_icd10cm="DIAG|ICD10:") == [
        ("10:", 9), ("9:4", 9), ("I1", 10), ("I10", 10),
    ]


def test_medications(make):
    members = make.cohort((1, "2020-03-20", "2020-03-20"), (2, "2020-03-20"))
    med_map = make.med_map(("ACEI", "ATC", "X"), ("ACEI", "RxNorm", "X"), ("HCQ", "ATC", "X"), ("ARB", "ATC", "Y"))
    facts = make.facts(
        (1, "X", "2020-03-01 00:00"),
        (1, "X", "2020-03-02 00:00"),
        (2, "X", "2020-03-20 00:00"),
        (2, "Y", "2020-03-15 00:00"),
        (2, "Z", "2020-03-20 00:00"),
    )
    assert rows(history.medications(facts, members, med_map)) == [
        ("ACEI", 1, 1, 1, 0),
        ("ARB", 0, 0, 0, 0),
        ("HCQ", 1, 1, 1, 0),
    ]
