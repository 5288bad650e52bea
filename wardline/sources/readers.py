"""The four clinical tables of a site."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardline.config import SiteConfig
from wardline.sources import schemas


@dataclass(frozen=True)
class Sources:
    """Facts, visits, patients and concepts as DataFrames."""

    facts: DataFrame
    visits: DataFrame
    patients: DataFrame
    concepts: DataFrame


def read_tables(
    spark: SparkSession,
    facts: str = "observation_fact",
    visits: str = "visit_dimension",
    patients: str = "patient_dimension",
    concepts: str = "concept_dimension",
) -> Sources:
    """Tables (or views) of the session's catalog."""
    return Sources(*[spark.table(name) for name in (facts, visits, patients, concepts)])


def read_parquet(spark: SparkSession, directory: str) -> Sources:
    """One parquet table per name under ``directory``.

    Facts stored by month and sorted by concept let the date bounds and code
    filters of the operators skip files and row groups.
    """
    names = ("observation_fact", "visit_dimension", "patient_dimension", "concept_dimension")
    return Sources(*[spark.read.parquet(f"{directory}/{name}") for name in names])


def read_csv(spark: SparkSession, directory: str, text_ids: bool = False) -> Sources:
    """One CSV extract with header per table, read with the declared schemas.

    Headers must be those of the schema, in its order, and every value must parse; a file
    that breaks this fails the job that reads it.  ``text_ids`` reads ``patient_num`` as text.
    """

    def read(name, schema):
        if text_ids:
            schema = schemas.with_text_ids(schema)
        return strict_csv(spark, f"{directory}/{name}.csv", schema)

    return Sources(
        read("observation_fact", schemas.OBSERVATION_FACT),
        read("visit_dimension", schemas.VISIT_DIMENSION),
        read("patient_dimension", schemas.PATIENT_DIMENSION),
        read("concept_dimension", schemas.CONCEPT_DIMENSION),
    )


def strict_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file whose header and values must fit the schema."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST")


def read_config(spark: SparkSession, path: str, as_of: date, **choices) -> SiteConfig:
    """A one-row CSV config table with header."""
    table = strict_csv(spark, path, schemas.CONFIG)
    return SiteConfig.from_table(table, as_of, **choices)
