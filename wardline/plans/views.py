"""Tables, maps and steps of a study under names that SQL can use.

    with SqlNames(study) as names:
        names.sql("SELECT * FROM index_events_by_result(array('LOINC:X'), 'positive')")

Tables, maps and steps are temporary views, steps with a parameter are table functions.  A
name that the session already has is never replaced.  Names are released on closing;
DataFrames made of them stay valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardline.plans.study import Study

VIEWS = {
    "observation_fact": lambda s: s.sources.facts,
    "visit_dimension": lambda s: s.sources.visits,
    "patient_dimension": lambda s: s.sources.patients,
    "concept_dimension": lambda s: s.sources.concepts,
    "code_map": lambda s: s.code_map,
    "lab_map": lambda s: s.lab_map,
    "med_map": lambda s: s.med_map,
}
STEPS = {
    "index_events": lambda s: s.index_events,
    "admissions": lambda s: s.admissions,
    "cohort": lambda s: s.cohort,
}
# Name: (parameters, columns, body); {id} is the type of patient_num, {p} the prefix of names.
FUNCTIONS = {
    "index_events_by_result": (
        "codes ARRAY<STRING>, result STRING",
        "patient_num {id}, covid_pos_date DATE",
        """SELECT f.patient_num, CAST(min(f.start_date) AS DATE)
           FROM {p}observation_fact f
           WHERE array_contains({p}index_events_by_result.codes, f.concept_cd)
             AND lower(f.tval_char) = lower({p}index_events_by_result.result)
           GROUP BY f.patient_num""",
    ),
    "facts_of_code": (
        "map_code STRING",
        "patient_num {id}, concept_cd STRING, day DATE",
        """SELECT f.patient_num, f.concept_cd, CAST(f.start_date AS DATE)
           FROM {p}observation_fact f LEFT SEMI JOIN {p}code_map m
             ON f.concept_cd = m.local_code AND m.code = {p}facts_of_code.map_code""",
    ),
}
STEP_FUNCTIONS = {
    "admitted_between": (
        "first_day DATE, last_day DATE",
        "patient_num {id}, admission_date DATE, discharge_date DATE",
        """SELECT a.patient_num, a.admission_date, a.discharge_date FROM {p}admissions a
           WHERE a.admission_date BETWEEN {p}admitted_between.first_day AND {p}admitted_between.last_day""",
    ),
}


class SqlNames:
    """Views and functions over a study.  ``steps`` also registers its steps, which runs them."""

    def __init__(self, study: Study, prefix: str = "", steps: bool = False) -> None:
        self.spark = study.sources.facts.sparkSession
        self.prefix = prefix
        self._made: list[tuple[str, str]] = []
        kind = dict(study.sources.facts.dtypes)["patient_num"].upper()
        try:
            for name, table in (VIEWS | (STEPS if steps else {})).items():
                table(study).createTempView(prefix + name)
                self._made.append(("VIEW", prefix + name))
            for name, (parameters, columns, body) in (FUNCTIONS | (STEP_FUNCTIONS if steps else {})).items():
                columns, body = columns.format(id=kind), body.format(p=prefix)
                self.spark.sql(f"CREATE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
                self._made.append(("TEMPORARY FUNCTION", prefix + name))
        except Exception:
            self.close()
            raise

    def sql(self, query: str) -> DataFrame:
        return self.spark.sql(query)

    def close(self) -> None:
        """Release the names."""
        while self._made:
            kind, name = self._made.pop()
            self.spark.sql(f"DROP {kind} IF EXISTS {name}")

    def __enter__(self) -> SqlNames:
        return self

    def __exit__(self, *error) -> None:
        self.close()
