"""Cutting the fact table down to what a cohort needs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.functions.clinical import severe_by_code
from wardline.operators.bloom import bloom_filter
from wardline.storage import fits_broadcast

MONTH = "start_month"  # of facts stored by month: year * 100 + month
LOOKBACK_DAYS = 365  # how long before admission diagnoses and medications count
SALTS_CONF = "wardline.salts"
SALTS = 32  # parts a key's rows are dealt to where nothing else is set


def salts(rows: DataFrame) -> int:
    """Parts that one key's rows are dealt to: ``wardline.salts`` of the session.

    Set it to the rows of the hottest key over what a task should hold.
    """
    return max(1, int(rows.sparkSession.conf.get(SALTS_CONF, str(SALTS))))


def within(first: date | None, days: int) -> Column:
    """Facts no older than ``days`` after the first admission of any cohort member.

    The date is a literal, as only literals reach the scan, where they skip files and row
    groups.  Without a date nothing is left out.
    """
    if first is None:
        return F.lit(True)
    return F.col("start_date") >= F.lit(first + timedelta(days=days))


def since(facts: DataFrame, first: date | None, days: int) -> DataFrame:
    """Facts as :func:`within` keeps them.  Of facts that carry their month, older months are not opened."""
    if first is None:
        return facts
    recent = facts.filter(within(first, days))
    if MONTH not in facts.columns:
        return recent
    opens = first + timedelta(days=days)
    return recent.filter(F.col(MONTH) >= opens.year * 100 + opens.month)


def lookup(
    rows: DataFrame, table: DataFrame, key: str, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Rows joined to a smaller table, safe for keys that very many rows share.

    A table that fits is broadcast and the rows stay where they are.  Otherwise both
    sides are shuffled by key and salt, the table once per salt, so that no key's rows
    end up in one task.  The salt is a hash of ``spread_by``: a task that runs twice
    sends its rows to the same places.
    """
    if fits_broadcast(table):
        return rows.join(table, key, how)
    parts = salts(rows)
    spread = rows.withColumn("salt", F.pmod(F.xxhash64(*spread_by), F.lit(parts)).cast("int"))
    copies = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return spread.join(copies, [key, "salt"], how).drop("salt")


def join_codes(facts: DataFrame, codes: DataFrame, how: str = "inner") -> DataFrame:
    """Facts joined to a table of codes on ``concept_cd``."""
    return lookup(facts, codes, "concept_cd", ["patient_num", "start_date"], how)


def rows_of(rows: DataFrame, patients: DataFrame, spread_by: list[str]) -> DataFrame:
    """Rows of the given patients (a written table, one row per patient), row by row.

    Beyond the broadcast limit a Bloom filter of the patients drops most rows of others
    before the rest is shuffled to be joined exactly.
    """
    keys = patients.select("patient_num")
    if not fits_broadcast(keys):
        bloom = bloom_filter(keys, "patient_num")
        if bloom:
            rows = rows.filter(bloom.may_hold(F.col("patient_num")))
    return lookup(rows, keys, "patient_num", spread_by, "left_semi")


def facts_of(facts: DataFrame, patients: DataFrame) -> DataFrame:
    """Facts of the given patients, as in :func:`rows_of`."""
    return rows_of(facts, patients, ["concept_cd", "start_date"])


def report_facts(
    facts: DataFrame,
    code_map: DataFrame,
    lab_map: DataFrame,
    med_map: DataFrame,
    cfg: SiteConfig,
    first: date | None = None,
) -> DataFrame:
    """Facts that any table of the report can use: mapped codes, diagnoses, severe procedures.

    Codes of the code map (races) count at any age.  All others count from the earliest
    day that a window of a cohort first admitted on ``first`` opens.
    """
    concept = F.col("concept_cd")
    mapped = (
        code_map.select(F.col("local_code").alias("concept_cd"), F.lit(True).alias("ever"))
        .union(lab_map.select("local_lab_code", F.lit(False)))
        .union(med_map.select("local_med_code", F.lit(False)))
        .groupBy("concept_cd")
        .agg(F.max("ever").alias("ever"))
    )
    wanted = F.col("ever").isNotNull() | severe_by_code(concept, cfg)
    for prefix in (cfg.code_prefix_icd9cm, cfg.code_prefix_icd10cm):
        if prefix:
            wanted = wanted | concept.startswith(prefix)
    opens = within(first, min(-LOOKBACK_DAYS, cfg.lab_min_day))
    return (
        join_codes(facts, mapped, "left")
        .filter(wanted & (F.coalesce("ever", F.lit(False)) | opens))
        .select(facts.columns)
    )
