"""Reproducible noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 7


def noise(bound: int, salt: str, table: str, key: list[str], column: str) -> Column:
    """A whole number in [-bound, bound] that depends on salt, table, row key and column.

    A random column could change when a task is retried or a plan is read twice;
    a hash of the cell's address cannot.
    """
    address = F.concat_ws(
        "|", F.lit(salt), F.lit(table), *[F.col(k).cast("string") for k in key], F.lit(column)
    )
    draw = F.conv(F.substring(F.md5(address), 1, HEX_DIGITS), 16, 10).cast("long")
    share = draw / F.lit(float(16**HEX_DIGITS))
    return (F.floor(share * F.lit(2 * bound + 1)) - F.lit(bound)).cast("long")
