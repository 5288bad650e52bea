"""Resampling documents towards a target distribution by hashed word features (operator 12).

1. Words of a text (ASCII letters in lower case, digits, and everything beyond ASCII) and
   runs of words are features, hashed to ``BUCKETS`` buckets.  One pass counts them over
   all documents and over all target texts; partial counts are added in each task, so a
   bucket count is what reaches the driver.
2. A bucket's gain is its log ratio of target to corpus, in thousandths.  A second pass
   adds the gains of each text from an array and adds seeded Gumbel noise, which turns the
   largest scores into a draw without replacement.
3. The eligible rows are ranked by a distributed LSD radix sort of the key (falling score,
   rising ``doc_id``).  Rows have positions; a block is a stretch of positions.  A pass
   counts rows by block and digit, a prefix sum over digits and blocks says where each
   block's rows of a digit go, and each block deals its rows out in order, so the sort is
   stable.  After the last digit the position is the rank.  Blocks are cut by position,
   never by key, so ties and hot keys cannot fill one.  Rows are written after each pass.

Defined cases: null and empty texts have no features, weight 0 and are not eligible; a null
``doc_id`` has no seed: its score and rank are null.  Repeated rows are ranked one behind the
other.  An empty target or corpus counts 0 everywhere.  An empty table gives no rows.
``doc_id`` must be a whole number.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.words import CACHED_WORDS, in_batches
from wardline.storage import materialize

BUCKETS = 10_000
ORDERS = (1, 1)  # shortest and longest run of words
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
DIGIT_BITS = 12
LEAST_BLOCK, MOST_BLOCK = 10, 20  # block sizes, as powers of two

_OTHER = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_PLAIN = bytearray(range(256))
for _c in _OTHER:
    _PLAIN[_c] = 0x20
for _c in range(0x41, 0x5B):
    _PLAIN[_c] = _c + 0x20
_PLAIN = bytes(_PLAIN)


class Buckets(dict):
    """The bucket of a feature.  Kept for the features met before, up to a fixed number."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.buckets
        return value


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_PLAIN).split()


def buckets_of(words: list[bytes], orders: tuple[int, int], known: Buckets) -> np.ndarray:
    """Buckets of all runs of ``orders[0]`` to ``orders[1]`` words, repeats included."""
    found = []
    for n in range(orders[0], orders[1] + 1):
        runs = words if n == 1 else [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        found.append(np.fromiter(map(known.__getitem__, runs), np.int64, len(runs)))
    return np.concatenate(found)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, orders: tuple[int, int] = ORDERS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(buckets_of(words_of(data.as_py()), orders, known), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("binary")).transform(in_batches, count, "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(buckets, np.int64)
    for row in rows:
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratios of target to corpus in thousandths, each count with one added."""
    n = len(corpus)
    all_corpus, all_target = float(corpus.sum() + n), float(target.sum() + n)
    ratios = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for s, t in ratios], np.int64)


def noise(doc_id: int, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, orders: tuple[int, int] = ORDERS, seed: int = SEED) -> DataFrame:
    """Every row's (doc_id, n_words, n_features, weight, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        known = Buckets(len(gain))
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(data.as_py())
                found = buckets_of(words, orders, known)
                weight = int(gain[found].sum())
                rows.append((doc_id, len(words), len(found), weight, None if doc_id is None else weight + noise(doc_id, seed)))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return asked.transform(in_batches, score, ", ".join(f"{c} long" for c in names))


def _bits(low: int, high: int) -> int:
    return (high - low).bit_length()


def _digit(shift: int, low_bits: int) -> Column:
    """``DIGIT_BITS`` bits from ``shift`` on, of a key whose lowest bits are ``low`` and the others ``high``."""
    if shift >= low_bits:
        value = F.shiftrightunsigned("high", shift - low_bits)
    else:
        value = F.shiftrightunsigned("low", shift)
        if shift + DIGIT_BITS > low_bits:
            value = value.bitwiseOR(F.shiftleft("high", low_bits - shift))
    return value.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")


def _deal(rows: pa.Table, offsets: pa.Table) -> pa.Table:
    """A block's rows in order of digit, rows of a digit in the order they had, at their new positions."""
    if not rows.num_rows:
        return rows.select(["row", "high", "low", "pos"])
    base = np.zeros(1 << DIGIT_BITS, np.int64)
    base[offsets["code"].to_numpy()] = offsets["base"].to_numpy()
    along = np.argsort(rows["pos"].to_numpy())
    digit = rows["digit"].to_numpy()[along]
    by = np.argsort(digit, kind="stable")  # numpy's stable sort of small integers counts them
    digit = digit[by]
    place = base[digit] + np.arange(len(digit)) - np.searchsorted(digit, digit)
    moved = rows.select(["row", "high", "low"]).take(pa.array(along[by]))
    return moved.append_column("pos", pa.array(place))


def radix_positions(rows: DataFrame, n: int, high_bits: int, low_bits: int) -> DataFrame:
    """Rows (row, high, low, pos) with ``pos`` made their place, from 0, in order of (high, low).

    ``pos`` says the order of equal keys; any distinct numbers will do.  ``n`` is the number
    of rows, ``high_bits`` and ``low_bits`` the widths of the keys as unsigned numbers.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(max(LEAST_BLOCK, (n // (4 * tasks)).bit_length()), MOST_BLOCK)
    for shift in range(0, max(1, high_bits + low_bits), DIGIT_BITS):
        cut = rows.withColumns({"block": F.shiftright("pos", size), "digit": _digit(shift, low_bits)})
        counts = cut.groupBy("block", "digit").agg(F.count("*").alias("n"))
        digits = counts.groupBy("digit").agg(F.sum("n").alias("all"))  # at most 2^DIGIT_BITS rows
        before = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        starts = digits.select("digit", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("start"))
        along = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        inside = counts.withColumn("inside", F.coalesce(F.sum("n").over(along), F.lit(0)))
        base = (F.col("start") + F.col("inside")).alias("base")
        offsets = inside.join(starts, "digit").select(F.col("block").alias("at"), F.col("digit").alias("code"), base)
        moved = cut.groupBy("block").cogroup(offsets.groupBy("at")).applyInArrow(_deal, "row long, high long, low long, pos long")
        rows = materialize(moved, f"radix-{shift}")
    return rows


def drawn_ranks(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(row, rank) of the drawn share of the eligible rows of ``scored``, which has a distinct ``row`` for each."""
    able = scored.filter((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    ends = [F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id")]
    n, least, most, first, last = able.agg(F.count("*"), *ends).first()
    if not n:
        return able.select("row", F.col("row").alias("rank"))
    if first < 0:  # in the order of unsigned numbers
        low, low_bits = F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63))), 64
    else:
        low, low_bits = F.col("doc_id"), _bits(0, last)
    keys = able.select("row", (F.lit(most) - F.col("score")).alias("high"), low.alias("low"), F.col("row").alias("pos"))
    placed = radix_positions(keys, n, _bits(least, most), low_bits)
    return placed.filter(F.col("pos") < percent * n // 100).select("row", (F.col("pos") + 1).alias("rank"))


def importance_resampling(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS,
    orders: tuple[int, int] = ORDERS, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """Every row's (doc_id, n_features, weight, score, rank); ``rank`` is null for rows not drawn."""
    gains = bucket_gains(bucket_counts(docs, buckets, orders), bucket_counts(target, buckets, orders))
    numbered = scores(docs, gains, orders, seed).withColumn("row", F.monotonically_increasing_id())
    scored = materialize(numbered, "scores")
    ranks = drawn_ranks(scored, percent, least_words)
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **settings) -> DataFrame:
    """The documents drawn; all columns as they were.  Rows that share a drawn ``doc_id`` all come."""
    drawn = importance_resampling(docs, target, percent, **settings).filter("rank is not null")
    return docs.join(drawn.select("doc_id").distinct(), "doc_id", "left_semi").select(docs.columns)
