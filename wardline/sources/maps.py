"""Mapping tables: the default rows, and readers for a site's own rows.

The default rows become local relations, whose size Spark knows, so joins to them
are broadcast by the planner's own size rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources import schemas
from wardline.sources.readers import strict_csv

# Code map (code, local code).
CODE_MAP_ROWS = [
    ("inpatient", "I"),
    ("inpatient", "IN"),
    ("male", "M"),
    ("male", "Male"),
    ("female", "F"),
    ("female", "Female"),
    ("american_indian", "NA"),
    ("asian", "A"),
    ("asian", "AS"),
    ("black", "B"),
    ("hawaiian_pacific_islander", "H"),
    ("hawaiian_pacific_islander", "P"),
    ("white", "W"),
    ("hispanic_latino", "DEM|HISP:Y"),
    ("hispanic_latino", "DEM|HISPANIC:Y"),
    ("covidpos", "LOINC:COVID19POS"),
]

# Labs (LOINC, scale factor, units, name).
LAB_ROWS = [
    ("6690-2", 1.0, "10*3/uL", "white blood cell count (Leukocytes)"),
    ("751-8", 1.0, "10*3/uL", "neutrophil count"),
    ("731-0", 1.0, "10*3/uL", "lymphocyte count"),
    ("1751-7", 1.0, "g/dL", "albumin"),
    ("2532-0", 1.0, "U/L", "lactate dehydrogenase (LDH)"),
    ("1742-6", 1.0, "U/L", "alanine aminotransferase (ALT)"),
    ("1920-8", 1.0, "U/L", "aspartate aminotransferase (AST)"),
    ("1975-2", 1.0, "mg/dL", "total bilirubin"),
    ("2160-0", 1.0, "mg/dL", "creatinine"),
    ("49563-0", 1.0, "ng/mL", "cardiac troponin (High Sensitivity)"),
    ("6598-7", 1.0, "ug/L", "cardiac troponin (Normal Sensitivity)"),
    ("48065-7", 1.0, "ng/mL{FEU}", "D-dimer (FEU)"),
    ("48066-5", 1.0, "ng/mL{DDU}", "D-dimer (DDU)"),
    ("5902-2", 1.0, "s", "prothrombin time (PT)"),
    ("33959-8", 1.0, "ng/mL", "procalcitonin"),
    ("1988-5", 1.0, "mg/L", "C-reactive protein (CRP) (Normal Sensitivity)"),
    ("3255-7", 1.0, "mg/dL", "Fibrinogen"),
    ("2276-4", 1.0, "ng/mL", "Ferritin"),
    ("2019-8", 1.0, "mmHg", "PaCO2"),
    ("2703-7", 1.0, "mmHg", "PaO2"),
]

# ATC codes of each medication class.
ATC_CODES = {
    "ACEI": [
        "C09AA01", "C09AA02", "C09AA03", "C09AA04", "C09AA05", "C09AA06", "C09AA07",
        "C09AA08", "C09AA09", "C09AA10", "C09AA11", "C09AA13", "C09AA15", "C09AA16",
    ],
    "ARB": [
        "C09CA01", "C09CA02", "C09CA03", "C09CA04", "C09CA06", "C09CA07", "C09CA08",
    ],
    "COAGA": [
        "B01AC04", "B01AC05", "B01AC07", "B01AC10", "B01AC13", "B01AC16", "B01AC17",
        "B01AC22", "B01AC24", "B01AC25", "B01AC26",
    ],
    "COAGB": [
        "B01AA01", "B01AA03", "B01AA04", "B01AA07", "B01AA11", "B01AB01", "B01AB04",
        "B01AB05", "B01AB06", "B01AB07", "B01AB08", "B01AB10", "B01AB12", "B01AE01",
        "B01AE02", "B01AE03", "B01AE06", "B01AE07", "B01AF01", "B01AF02", "B01AF03",
        "B01AF04", "B01AX05", "B01AX07",
    ],
    "COVIDVIRAL": ["J05AE10", "J05AP01", "J05AR10"],
    "DIURETIC": [
        "C03CA01", "C03CA02", "C03CA03", "C03CA04", "C03CB01", "C03CB02", "C03CC01",
    ],
    "HCQ": ["P01BA01", "P01BA02"],
    "ILI": ["L04AC03", "L04AC07", "L04AC11", "L04AC14"],
    "INTERFERON": ["L03AB08", "L03AB11"],
    "SIANES": [
        "M03AC03", "M03AC09", "M03AC11", "N01AX03", "N01AX10", "N05CD08", "N05CM18",
    ],
    "SICARDIAC": [
        "B01AC09", "C01CA03", "C01CA04", "C01CA06", "C01CA07", "C01CA24", "C01CE02",
        "C01CX09", "H01BA01", "R07AX01",
    ],
}

# Rows of the class without an ATC list.
REMDESIVIR_ROWS = [
    ("REMDESIVIR", "RxNorm", "RxNorm:2284718"),
    ("REMDESIVIR", "RxNorm", "RxNorm:2284960"),
    ("REMDESIVIR", "Custom", "ACT|LOCAL:REMDESIVIR"),
]


RXNORM = T.StructType([T.StructField("med_class", T.StringType()), T.StructField("code", T.StringType())])


@dataclass(frozen=True)
class Maps:
    """The three mapping tables of a site."""

    code_map: DataFrame
    lab_map: DataFrame
    med_map: DataFrame


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows as a local relation (through Arrow), which carries its exact size."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow = {T.StringType: pa.string(), T.DoubleType: pa.float64(), T.LongType: pa.int64()}
    table = pa.table(
        [pa.array(c, arrow[type(f.dataType)]) for c, f in zip(columns, schema)],
        names=schema.names,
    )
    return spark.createDataFrame(table)


def default_code_map(spark: SparkSession) -> DataFrame:
    return local_rows(spark, CODE_MAP_ROWS, schemas.CODE_MAP)


def default_lab_map(spark: SparkSession, prefix: str = "LOINC:") -> DataFrame:
    rows = [(loinc, prefix + loinc, scale, units, name) for loinc, scale, units, name in LAB_ROWS]
    return local_rows(spark, rows, schemas.LAB_MAP)


def default_med_map(
    spark: SparkSession, atc_prefix: str = "ATC:", rxnorm: DataFrame | None = None,
    rxnorm_prefix: str = "RxNorm:",
) -> DataFrame:
    """ATC and remdesivir rows, plus the RxNorm rows a site supplies.

    ``rxnorm`` has columns ``med_class`` and ``code`` (for example from
    :func:`read_rxnorm_classes`): the RxNorm list is a file, not part of the code.
    """
    rows = [(m, "ATC", atc_prefix + c) for m, codes in ATC_CODES.items() for c in codes]
    med_map = local_rows(spark, rows + REMDESIVIR_ROWS, schemas.MED_MAP)
    if rxnorm is None:
        return med_map
    added = rxnorm.select(
        "med_class",
        F.lit("RxNorm").alias("code_type"),
        F.concat(F.lit(rxnorm_prefix), F.col("code").cast("string")).alias("local_med_code"),
    )
    return med_map.unionByName(added).distinct()


def default_maps(spark: SparkSession, rxnorm: DataFrame | bool) -> Maps:
    """The built-in maps with a site's RxNorm rows; ``rxnorm=False`` says that it has none.

    There is no default: without its RxNorm codes a site finds fewer severe patients and
    fewer medications, and nothing in the tables shows it.
    """
    if rxnorm is True or rxnorm is None:
        raise ValueError("rxnorm must be a table (med_class, code), or False for a site without RxNorm codes")
    classes = None if rxnorm is False else rxnorm
    return Maps(default_code_map(spark), default_lab_map(spark), default_med_map(spark, rxnorm=classes))


def read_rxnorm_classes(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header ``med_class,code``."""
    return strict_csv(spark, path, RXNORM)


def read_maps(spark: SparkSession, code_map: str, lab_map: str, med_map: str) -> Maps:
    """A site's own mapping files: CSV with header, columns as in the declared schemas."""

    def read(path: str, schema: T.StructType) -> DataFrame:
        return strict_csv(spark, path, schema)

    return Maps(
        read(code_map, schemas.CODE_MAP).distinct(),
        read(lab_map, schemas.LAB_MAP).distinct(),
        read(med_map, schemas.MED_MAP).distinct(),
    )
