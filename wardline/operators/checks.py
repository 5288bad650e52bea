"""Declared rules of a table, as counts of the rows that break them."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import SITE_ID_PATTERN
from wardline.operators.tables import TABLES, TableSpec


@dataclass(frozen=True)
class Rule:
    """``unique`` over some columns, or ``not_null`` / ``max_length`` / ``matches`` of one."""

    kind: str
    columns: tuple[str, ...]
    argument: int | str | None = None

    @property
    def label(self) -> str:
        return self.kind if self.argument is None else f"{self.kind}({self.argument})"


def unique(*columns: str) -> Rule:
    return Rule("unique", columns)


def not_null(column: str) -> Rule:
    return Rule("not_null", (column,))


def max_length(column: str, length: int) -> Rule:
    return Rule("max_length", (column,), length)


def site_id(column: str = "siteid") -> Rule:
    return Rule("matches", (column,), SITE_ID_PATTERN)


# Declared keys and lengths of the mapping and intermediate tables.
MAP_RULES = {
    "code_map": [
        unique("code", "local_code"),
        not_null("code"),
        not_null("local_code"),
        max_length("code", 50),
        max_length("local_code", 50),
    ],
    "lab_map": [
        unique("loinc", "local_lab_code"),
        not_null("loinc"),
        not_null("local_lab_code"),
        max_length("loinc", 20),
        max_length("local_lab_code", 50),
        max_length("lab_units", 20),
        max_length("lab_name", 100),
    ],
    "med_map": [
        unique("med_class", "code_type", "local_med_code"),
        not_null("med_class"),
        not_null("code_type"),
        not_null("local_med_code"),
        max_length("med_class", 50),
        max_length("code_type", 10),
        max_length("local_med_code", 50),
    ],
}
STEP_RULES = {
    "index_events": [unique("patient_num", "covid_pos_date"), not_null("covid_pos_date")],
    "admissions": [
        unique("patient_num", "admission_date", "discharge_date"),
        not_null("admission_date"),
        not_null("discharge_date"),
    ],
    "cohort": [unique("patient_num"), not_null("patient_num")],
    "date_list": [unique("d"), not_null("d")],
    "concept_dimension": [unique("concept_path")],
}
# Declared lengths of the output columns.
OUTPUT_LENGTHS = {
    "siteid": 50,
    "sex": 10,
    "age_group": 20,
    "race": 30,
    "loinc": 20,
    "units": 20,
    "icd_code_3chars": 10,
    "med_class": 20,
}


def output_rules(spec: TableSpec) -> list[Rule]:
    """Key, not-null, length and site-id rules of one output table."""
    rules = [unique(*spec.key), site_id()]
    rules += [not_null(c) for c in ["siteid", *spec.key]]
    rules += [max_length(c, n) for c, n in OUTPUT_LENGTHS.items() if c in spec.with_site]
    return rules


OUTPUT_RULES = {spec.name: output_rules(spec) for spec in TABLES}


def _broken(rule: Rule) -> Column:
    column = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return column.isNull()
    if rule.kind == "max_length":
        return F.length(column.cast("string")) > rule.argument
    return ~column.rlike(str(rule.argument))


def check_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Violations: (table_name, rule, column_names, value, n_rows), empty when all hold.

    ``value`` is the repeated key (its missing parts as ``null``), or the value that breaks
    a rule (null for a missing one).  One pass and one shuffle check all rules: each row
    gives its keys, and the values that break a rule, under the rule's number, and all are
    counted together, in each task first.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], "table_name string, rule string, column_names string, value string, n_rows long")

    def found(number: int, rule: Rule) -> Column:
        value = F.array(*[F.col(c).cast("string") for c in rule.columns])
        row = F.struct(F.lit(number).alias("number"), value.alias("parts"))
        return row if rule.kind == "unique" else F.when(_broken(rule), row)

    def named(texts: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, texts)), F.col("number") + 1)

    unique_rule = named([r.kind for r in rules]) == "unique"
    whole = F.concat_ws("|", F.transform("parts", lambda p: F.coalesce(p, F.lit("null"))))
    return (
        df.select(F.inline(F.array_compact(F.array(*[found(k, r) for k, r in enumerate(rules)]))))
        .groupBy("number", "parts")
        .agg(F.count("*").alias("n_rows"))
        .filter(~unique_rule | (F.col("n_rows") > 1))
        .select(
            F.lit(table).alias("table_name"),
            named([r.label for r in rules]).alias("rule"),
            named([",".join(r.columns) for r in rules]).alias("column_names"),
            F.when(unique_rule, whole).otherwise(F.element_at("parts", 1)).alias("value"),
            "n_rows",
        )
    )
