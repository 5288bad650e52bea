"""Adapter: the driver's test tables seen as clinical tables (formulas in FIXTURES.md).

Time columns are TIMESTAMP_NTZ, as in the test files, so no result depends on the
session time zone.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.operators.expansion import codes_under_path
from wardline.sources import maps as default
from wardline.sources import schemas
from wardline.sources.maps import Maps, local_rows

AS_OF = date(2020, 12, 31)
YEARS_APART = 400  # days, for a calendar of several years

# Concept of a fact by part key modulo 200: (last value of the range, concept).
CONCEPT_RANGES = [
    (6, "LOINC:COVID19POS"),
    (7, "LOCAL:COVIDPOS2"),
    (27, "LOINC:6690-2"),
    (39, "LOINC:2160-0"),
    (51, "LOINC:1988-5"),
    (63, "LOINC:48065-7"),
    (64, "LOINC:2019-8"),
    (65, "LOINC:2703-7"),
    (79, "DIAG|ICD10:I10"),
    (91, "DIAG|ICD10:E11.9"),
    (103, "DIAG|ICD10:J18.9"),
    (104, "DIAG|ICD10:J80"),
    (105, "DIAG|ICD10:J95.851"),
    (117, "DIAG|ICD9:401.9"),
    (129, "DIAG|ICD9:250.00"),
    (130, "DIAG|ICD9:518.82"),
    (131, "PROC|ICD10:0BH17EZ"),
    (132, "PROC|ICD10:5A0935Z"),
    (137, "PROC|ICD10:5A1955Z"),
    (138, "PROC|ICD9:96.71"),
    (139, "PROC|ICD9:96.04"),
    (149, "ATC:C09AA01"),
    (157, "RxNorm:36908"),
    (165, "ATC:P01BA01"),
    (169, "RxNorm:2284718"),
    (170, "ATC:N01AX10"),
    (171, "ATC:C01CA03"),
    (179, "DEM|HISP:Y"),
    (184, "LOCAL:WBC2"),
    (189, "LOCAL:ACEI2"),
    (199, "VITAL:HR"),
]

CONCEPT_ROWS = [
    ("\\SYN\\COVID\\", None),
    ("\\SYN\\COVID\\POS1\\", "LOINC:COVID19POS"),
    ("\\SYN\\COVID\\POS2\\", "LOCAL:COVIDPOS2"),
    ("\\SYN\\LAB_A\\WBC\\", "LOINC:6690-2"),
    ("\\SYN\\LAB_A\\WBC\\ALT\\", "LOCAL:WBC2"),
    ("\\SYN\\LABXA\\WBC\\", "VITAL:HR"),
    ("\\SYN\\Medications\\ACEI\\", "ATC:C09AA01"),
    ("\\SYN\\Medications\\ACEI\\LOCAL\\", "LOCAL:ACEI2"),
    ("\\SYN\\Medications\\ACEI\\UNUSED\\", "LOCAL:ACEI9"),
]
POSITIVE_PATH = "\\SYN\\COVID\\"
MEDICATION_ROOT = "\\SYN\\Medications\\"
PART_ROOT = "\\SYN\\PART\\"

RACE_CODES = ["NA", "A", "AS", "B", "H", "P", "W", "U"]
SEX_CODES = {
    "AUTOMOBILE": "M",
    "BUILDING": "Male",
    "FURNITURE": "F",
    "HOUSEHOLD": "Female",
    "MACHINERY": "U",
}
LOCAL_RXNORM_ROWS = [("ACEI", "RxNorm", "RxNorm:36908")]
CRP_LOINC, CRP_SCALE = "1988-5", 10.0


def config(**changes) -> SiteConfig:
    return SiteConfig(**{"as_of": AS_OF, "blur_salt": "test-salt", **changes})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(ts: str) -> Column:
    return F.datediff(F.to_date(ts), F.lit(date(1995, 1, 1)))


def _moment(day: Column, hour: Column) -> Column:
    return F.timestamp_add("HOUR", hour, day.cast("timestamp_ntz"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    branches = " ".join(f"WHEN l_partkey % 200 <= {last} THEN '{code}'" for last, code in CONCEPT_RANGES)
    concept = F.expr(f"CASE {branches} END")
    value = (
        F.when(F.col("l_partkey") % 23 == 0, None)
        .when(F.col("l_quantity") > 48, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
    )
    start = _moment(
        F.date_add(F.lit(date(2019, 9, 1)), _days("l_shipdate") % 360),
        (F.col("l_linenumber") * 5) % 24,
    )
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        concept.alias("concept_cd"),
        start.alias("start_date"),
        value.alias("nval_num"),
        F.when(F.col("l_returnflag") == "R", "POSITIVE").otherwise("Negative").alias("tval_char"),
    )
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient_num")
    )
    return lines.join(orders, "l_orderkey").select(
        "patient_num", "concept_cd", "start_date", "nval_num", "tval_char"
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    start_day = F.date_add(F.lit(date(2020, 3, 1)), _days("o_orderdate") % 120)
    hour = F.col("o_orderkey") % 24
    stay = (F.col("o_orderkey") % 15).cast("int")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("patient_num"),
        _moment(start_day, hour).alias("start_date"),
        F.when(F.col("o_orderkey") % 50 == 0, None)
        .otherwise(_moment(F.date_add(start_day, stay), hour))
        .alias("end_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "I")
        .when(F.col("o_orderpriority") == "2-HIGH", "IN")
        .otherwise("O")
        .alias("inout_cd"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    sexes = " ".join(f"WHEN '{segment}' THEN '{code}'" for segment, code in SEX_CODES.items())
    age = (key % 101).cast("int")
    return _table(spark, sf_dir, "customer").select(
        key.alias("patient_num"),
        F.expr(f"CASE c_mktsegment {sexes} END").alias("sex_cd"),
        F.when(key % 37 == 0, None).otherwise(age).alias("age_in_years_num"),
        F.date_sub(F.lit(date(2020, 6, 30)), 365 * age).alias("birth_date"),
        F.element_at(F.lit(RACE_CODES), F.col("c_nationkey") % 8 + 1).alias("race_cd"),
        F.when(balance < 0, F.date_add(F.lit(date(2020, 7, 15)), (key % 60).cast("int"))).alias(
            "death_date"
        ),
        F.when(balance < 500, "Y").otherwise("N").alias("vital_status_cd"),
    )


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand-made paths and one leaf per part."""
    part_key = F.col("p_partkey").cast("string")
    leaves = _table(spark, sf_dir, "part").select(
        F.concat(
            F.lit(PART_ROOT), "p_brand", F.lit("\\"), "p_type", F.lit("\\"), part_key, F.lit("\\")
        ).alias("concept_path"),
        F.concat(F.lit("PART:"), part_key).alias("concept_cd"),
    )
    return local_rows(spark, CONCEPT_ROWS, schemas.CONCEPT_DIMENSION).unionByName(leaves)


def brand_tree(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The concept tree with a node per brand above its parts, and a lab map of those nodes."""
    brands = _table(spark, sf_dir, "part").select("p_brand").distinct()
    code = F.concat(F.lit("BRAND:"), "p_brand")
    nodes = brands.select(
        F.concat(F.lit(PART_ROOT), "p_brand", F.lit("\\")).alias("concept_path"),
        code.alias("concept_cd"),
    )
    lab_map = brands.select(
        F.col("p_brand").alias("loinc"),
        code.alias("local_lab_code"),
        F.lit(1.0).alias("scale_factor"),
        F.lit("u").alias("lab_units"),
        F.col("p_brand").alias("lab_name"),
    )
    return concepts(spark, sf_dir).unionByName(nodes), lab_map


def large_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part codes as facts: the lines of at least forty pieces."""
    lines = _table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") >= 40)
    return lines.select(F.concat(F.lit("PART:"), F.col("l_partkey").cast("string")).alias("concept_cd"))


class TestTables:
    """The four clinical tables, each opened when first read (same fields as ``Sources``)."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, years_apart: bool = False) -> None:
        self._of = (spark, sf_dir)
        self._years_apart = years_apart

    def _dated(self, table: DataFrame, *columns: str) -> DataFrame:
        """Patients' times ``YEARS_APART`` days earlier for each unit of their key modulo 4, if asked for."""
        if not self._years_apart:
            return table
        back = F.make_dt_interval(F.col("patient_num") % 4 * YEARS_APART)
        return table.withColumns({c: F.col(c) - back for c in columns})

    @cached_property
    def facts(self) -> DataFrame:
        return self._dated(facts(*self._of), "start_date")

    @cached_property
    def visits(self) -> DataFrame:
        return self._dated(visits(*self._of), "start_date", "end_date")

    @cached_property
    def patients(self) -> DataFrame:
        return patients(*self._of)

    @cached_property
    def concepts(self) -> DataFrame:
        return concepts(*self._of)


def sources(spark: SparkSession, sf_dir: str, years_apart: bool = False) -> TestTables:
    return TestTables(spark, sf_dir, years_apart)


def positive_codes(spark: SparkSession, concept_table: DataFrame) -> DataFrame:
    """Positive codes of the concept tree that the default code map lacks."""
    return codes_under_path(concept_table, POSITIVE_PATH, default.default_code_map(spark))


def rxnorm_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site's RxNorm list: the facts' own code, and every part as a code of its brand, each twice."""
    own = local_rows(spark, [(m, c.removeprefix("RxNorm:")) for m, _, c in LOCAL_RXNORM_ROWS], default.RXNORM)
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("med_class"), F.col("p_partkey").cast("string").alias("code")
    )
    once = own.unionByName(parts)
    return once.unionByName(once)


def maps(spark: SparkSession, concept_table: DataFrame) -> Maps:
    """Default maps; positive codes also come from the concept tree; CRP is rescaled."""
    code_map = default.default_code_map(spark)
    positives = positive_codes(spark, concept_table)
    lab_map = default.default_lab_map(spark).withColumn(
        "scale_factor", F.when(F.col("loinc") == CRP_LOINC, CRP_SCALE).otherwise(F.col("scale_factor"))
    )
    med_map = default.default_med_map(spark).unionByName(
        local_rows(spark, LOCAL_RXNORM_ROWS, schemas.MED_MAP)
    )
    return Maps(code_map.unionByName(positives), lab_map, med_map)
