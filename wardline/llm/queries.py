"""Queries of the training-data operators over the test tables, with their SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import op1_token_shards as shards
from wardline.llm import op2_decontamination as leaks
from wardline.llm import op3_minhash_dedup as minhash
from wardline.llm import op4_language_id as language
from wardline.llm import op5_quality_rules as quality
from wardline.llm import op6_token_counts as counts
from wardline.llm import op7_substring_dedup as repeats
from wardline.llm import op8_secret_scan as secrets
from wardline.llm import op9_license_scan as licenses
from wardline.llm import op10_source_mix as mix
from wardline.llm import op11_toxicity as toxic
from wardline.llm import op12_importance_resampling as resampling
from wardline.llm import op13_embedding_whitening as embeddings
from wardline.llm.sql import ORACLE_SQL as ORACLE_SQL
from wardline.storage import materialize, scratch_folder

VOCABULARY = 49_408
END_ID = 2  # what the packed files end a document with
END_OF_TEXT = 49_407  # no text can bring this id where special tokens are read as text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def token_index(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents encoded to packed files, and what the files say of each."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = fresh_folder(spark, "tokens")
    shards.write_shards(docs, path, lambda: shards.word_encoder(vocabulary), VOCABULARY, END_ID)
    return shards.document_index(shards.read_blocks(spark, path))


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(spark, documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), words=3, percent=85)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document, counted in flat files by their separators alone."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = fresh_folder(spark, "flat")
    encoder = lambda: shards.word_encoder(vocabulary, special_as_text=True)
    counts.write_flat(documents(spark, sf_dir), path, encoder, END_OF_TEXT)
    found = materialize(counts.find_separators(counts.read_flat(spark, path), END_OF_TEXT), "separators")
    named = counts.token_counts(found).join(counts.document_order(spark, path), ["file", "ordinal"])
    return named.select("doc_id", "file", "ordinal", "start", "n_tokens")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.source_mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", F.col("target"), "taken")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_resampling(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.whitening(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_shards": op1_token_shards,
    "op2_decontamination": op2_decontamination,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_counts": op6_token_counts,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_license_scan": op9_license_scan,
    "op10_source_mix": op10_source_mix,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_embedding_whitening": op13_embedding_whitening,
}
