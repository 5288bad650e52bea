"""Declared input schemas; nothing is inferred."""

from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


OBSERVATION_FACT = _schema(
    ("patient_num", T.LongType()),
    ("concept_cd", T.StringType()),
    ("start_date", T.TimestampType()),
    ("nval_num", T.DoubleType()),
    ("tval_char", T.StringType()),
)
VISIT_DIMENSION = _schema(
    ("patient_num", T.LongType()),
    ("start_date", T.TimestampType()),
    ("end_date", T.TimestampType()),
    ("inout_cd", T.StringType()),
)
PATIENT_DIMENSION = _schema(
    ("patient_num", T.LongType()),
    ("sex_cd", T.StringType()),
    ("age_in_years_num", T.IntegerType()),
    ("birth_date", T.DateType()),
    ("race_cd", T.StringType()),
    ("death_date", T.DateType()),
    ("vital_status_cd", T.StringType()),
)
CONCEPT_DIMENSION = _schema(("concept_path", T.StringType()), ("concept_cd", T.StringType()))



def with_text_ids(schema: T.StructType) -> T.StructType:
    """The schema with ``patient_num`` as text."""
    return T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == "patient_num" else f for f in schema]
    )


CODE_MAP = _schema(("code", T.StringType()), ("local_code", T.StringType()))
LAB_MAP = _schema(
    ("loinc", T.StringType()),
    ("local_lab_code", T.StringType()),
    ("scale_factor", T.DoubleType()),
    ("lab_units", T.StringType()),
    ("lab_name", T.StringType()),
)
MED_MAP = _schema(
    ("med_class", T.StringType()),
    ("code_type", T.StringType()),
    ("local_med_code", T.StringType()),
)
CONFIG = _schema(
    ("siteid", T.StringType()),
    ("include_race", T.IntegerType()),
    ("race_in_fact_table", T.IntegerType()),
    ("hispanic_in_fact_table", T.IntegerType()),
    ("death_data_accurate", T.IntegerType()),
    ("code_prefix_icd9cm", T.StringType()),
    ("code_prefix_icd10cm", T.StringType()),
    ("code_prefix_icd9proc", T.StringType()),
    ("code_prefix_icd10pcs", T.StringType()),
    ("obfuscation_blur", T.IntegerType()),
    ("obfuscation_small_count_mask", T.IntegerType()),
    ("obfuscation_small_count_delete", T.IntegerType()),
    ("obfuscation_demographics", T.IntegerType()),
    ("output_as_columns", T.IntegerType()),
    ("output_as_csv", T.IntegerType()),
)
