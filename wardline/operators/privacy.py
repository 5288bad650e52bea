"""Protection of small counts: noise, masks, suppression and deletion.

All steps are projections and filters over report rows; none of them shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import SiteConfig
from wardline.functions.noise import noise
from wardline.operators.daily import NOT_AVAILABLE
from wardline.operators.demographics import DEMOGRAPHIC_COUNTS, DIMENSIONS
from wardline.operators.tables import DEMOGRAPHICS, TableSpec

SMALL = -99


def _keep_sentinel(column: str, changed: Column, protect: bool) -> Column:
    if not protect:
        return changed.alias(column)
    return F.when(F.col(column) == NOT_AVAILABLE, F.col(column)).otherwise(changed).alias(column)


def _replace(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    return df.select(*[changed.get(c, F.col(c)) for c in df.columns])


def blur_counts(
    df: DataFrame, spec: TableSpec, bound: int, salt: str, protect_sentinels: bool = False
) -> DataFrame:
    """Add to every count its own whole number between ``-bound`` and ``bound``."""
    key = spec.key + (["units"] if "units" in spec.columns else [])
    blurred = {
        c: _keep_sentinel(c, F.col(c) + noise(bound, salt, spec.name, key, c), protect_sentinels)
        for c in spec.counts
    }
    return _replace(df, blurred)


def mask_small(
    df: DataFrame, columns: list[str], limit: int, protect_sentinels: bool = False
) -> DataFrame:
    """Replace counts below ``limit`` by -99, cell by cell; true zeros too."""
    masked = {
        c: _keep_sentinel(
            c, F.when(F.col(c) < limit, F.lit(SMALL).cast("long")).otherwise(F.col(c)), protect_sentinels
        )
        for c in columns
    }
    return _replace(df, masked)


def mask_small_block(
    df: DataFrame, count: str, columns: list[str], limit: int, protect_sentinels: bool = False
) -> DataFrame:
    """Replace a count below ``limit`` and all statistics that go with it by -99."""
    small = F.col(count) < limit
    if protect_sentinels:
        small = small & (F.col(count) != NOT_AVAILABLE)
    types = dict(df.dtypes)
    masked = {
        c: F.when(small, F.lit(SMALL).cast(types[c])).otherwise(F.col(c)).alias(c)
        for c in [count, *columns]
    }
    return _replace(df, masked)


def mask_table(
    df: DataFrame, spec: TableSpec, limit: int, protect_sentinels: bool = False
) -> DataFrame:
    """Mask one output table: whole blocks where it has them, single cells elsewhere."""
    for count, columns in spec.blocks.items():
        df = mask_small_block(df, count, columns, limit, protect_sentinels)
    cells = [c for c in spec.counts if c not in spec.blocks]
    return mask_small(df, cells, limit, protect_sentinels)


def suppress_combinations(df: DataFrame) -> DataFrame:
    """Keep only counts of a single sex, age group or race; the others become -999."""
    alls = reduce(lambda a, b: a + b, [(F.col(d) == "all").cast("int") for d in DIMENSIONS])
    suppressed = {
        c: F.when(alls != 2, F.lit(NOT_AVAILABLE).cast("long")).otherwise(F.col(c)).alias(c)
        for c in DEMOGRAPHIC_COUNTS
    }
    return _replace(df, suppressed)


def delete_small(df: DataFrame, counts: list[str], limit: int) -> DataFrame:
    """Drop rows in which all of ``counts`` are below ``limit``; no counts, no deletion."""
    if not counts:
        return df
    small = reduce(lambda a, b: a & b, [F.col(c) < limit for c in counts])
    return df.filter(~small)


def with_site(df: DataFrame, cfg: SiteConfig) -> DataFrame:
    """Put the site id in front."""
    return df.select(F.lit(cfg.siteid).alias("siteid"), *[c for c in df.columns if c != "siteid"])


def protect(df: DataFrame, spec: TableSpec, cfg: SiteConfig) -> DataFrame:
    """All protection the site asks for, in the report's order.

    Sentinels set earlier (-999 for counts a site cannot give) are blurred and masked like
    counts unless ``cfg.protect_sentinels`` is set.
    """
    keep = cfg.protect_sentinels
    if cfg.obfuscation_blur > 0:
        df = blur_counts(df, spec, cfg.obfuscation_blur, cfg.blur_salt, keep)
    if cfg.obfuscation_small_count_mask > 0:
        df = mask_table(df, spec, cfg.obfuscation_small_count_mask, keep)
    if cfg.obfuscation_demographics and spec is DEMOGRAPHICS:
        df = suppress_combinations(df)
    if cfg.obfuscation_small_count_delete:
        df = delete_small(df, spec.delete_if_all_small, cfg.obfuscation_small_count_mask)
    return df
