"""A Bloom filter of keys, tested where large tables are scanned.

A table of keys too large to broadcast can still tell most other rows from its own before
they are shuffled: as a filter of a few bits per key.  Rows that pass are joined exactly
afterwards, so a filter never decides what a result holds.

Every key sets some bits of an array of 64-bit words.  Words are combined with ``bit_or``,
which Spark adds up in each task before it shuffles, one row per word.  The array reaches
the scan as a scalar subquery: it is computed once, and Spark sends it with the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS_CONF = "wardline.bloom.bits"
MOST_BITS = 1 << 26  # 8 MB, whatever the number of keys
FALSE_POSITIVES = 0.01
LEAST_BITS = 4  # per key: below that too many other rows pass to be worth it
MOST_HASHES = 8


@dataclass(frozen=True)
class Bloom:
    """The filter's words as a table of one row with one array, and how keys address it."""

    words: DataFrame
    bits: int
    hashes: int

    def may_hold(self, key: Column) -> Column:
        """False for rows whose key is certainly not among the keys; null keys may be either."""
        words = self.words.scalar()
        found = F.lit(True)
        for place in _places(key, self.bits, self.hashes):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, place.bitwiseAND(63).cast("int")) == 1)
        return found


def _places(key: Column, bits: int, hashes: int) -> list[Column]:
    """Bits of a key, by double hashing with the halves of a 64-bit hash."""
    h = F.xxhash64(key)
    first, step = F.shiftrightunsigned(h, 32), h.bitwiseAND(0x7FFFFFFF).bitwiseOR(1)
    return [F.pmod(first + step * i, F.lit(bits)) for i in range(hashes)]


def shape(n: int, most_bits: int, false_positives: float = FALSE_POSITIVES) -> tuple[int, int] | None:
    """Bits and hashes for ``n`` keys, or None where ``most_bits`` are too few for them."""
    wanted = math.ceil(-max(n, 1) * math.log(false_positives) / math.log(2) ** 2)
    bits = min(wanted, most_bits) // 64 * 64 + 64
    if bits < LEAST_BITS * n:
        return None
    return bits, min(MOST_HASHES, max(1, round(bits / max(n, 1) * math.log(2))))


def bloom_filter(keys: DataFrame, key: str, false_positives: float = FALSE_POSITIVES) -> Bloom | None:
    """The filter of a written table's keys; None if it would be too large to be of use.

    Counts the table, to size the filter; the filter itself is computed with the query
    that uses it.
    """
    spark = keys.sparkSession
    most = int(spark.conf.get(MOST_BITS_CONF, str(MOST_BITS)))
    found = shape(keys.count(), most, false_positives)
    if found is None:
        return None
    bits, hashes = found
    places = keys.select(F.explode(F.array(*_places(F.col(key), bits, hashes))).alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    used = places.select(F.shiftright("place", 6).alias("word"), one.alias("set"))
    every = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
    words = used.unionByName(every).groupBy("word").agg(F.bit_or("set").alias("set"))
    row = words.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("words"))
    return Bloom(row.select(F.col("words")["set"].alias("words")), bits, hashes)
