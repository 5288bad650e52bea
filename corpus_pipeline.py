"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns rows
with the columns of ``documents``; the last one returns the index of the packed token
files.  Between stages rows are written as Parquet below ``spark.checkpoint.dir`` and
read again, so a stage never reruns the ones before it.

A stage keeps rows as they are: nulls, extra columns and repeated rows pass through
unless the stage's decision drops them.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import op2_decontamination, op3_minhash_dedup, op4_language_id, op10_source_mix, queries
from wardline.storage import remove, tables_written, write_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not recognised."""
    return op4_language_id.in_known_language(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return op3_minhash_dedup.without_near_duplicates(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return op2_decontamination.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents up to its target, some of them several times."""
    return op10_source_mix.mixed(docs)


def packed_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the packed token files and returns their index."""
    return queries.token_index(spark, docs)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", distinct_texts),
    ("decontamination", clean_of_benchmark),
    ("source_mix", mixed_sources),
    ("token_shards", packed_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage writes for itself is removed when its result has been written, and its
    input when the next one has; the result and the packed token files stay.
    """
    docs, held = queries.documents(spark, sf_dir), []
    for name, stage in STAGES:
        with tables_written() as tables:
            found = stage(spark, docs, sf_dir)
            path = write_table(found, name)
        docs = spark.read.schema(found.schema).parquet(path)
        for table in [*held, *tables]:
            if table != path:
                remove(spark, table)
        held = [path]
    return docs


# Hashed n-grams, components and a tokenizer's ids are beyond SQL: tests compare with plain Python.
ORACLE_SQL = None
