"""Words, their hashes, shingles and min-wise hashes, as numpy arrays inside a task.

A word is a run of characters other than ASCII white space; A-Z are lower-cased.  Words
and shingles are compared by 64-bit hashes that depend on nothing but the text.
"""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CACHED_WORDS = 300_000

# ASCII punctuation as spaces, for matches that should not depend on it.
_PUNCTUATION = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))
PLAIN = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word.  Kept for the words met before, up to a fixed number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_caches: list = []
_owner: str | None = None


def kept(make):
    """``functools.cache`` for what a worker process keeps for all tasks of one operator."""
    made = cache(make)
    _caches.append(made)
    return made


def take_over(owner: str) -> None:
    """Drops what tasks of another operator have kept in this worker process, and gives the memory back.

    Worker processes outlive operators; without this each holds the tables of all it ran.
    """
    global _owner
    if owner == _owner:
        return
    _owner = owner
    for made in _caches:
        made.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps freed memory else
        trim(0)


@kept
def word_hashes() -> WordHashes:
    """The one table of word hashes that a worker process keeps for all the operator's tasks."""
    return WordHashes()


def words_of(text: str | None, plain: bool = False) -> list[bytes]:
    """The words of a text; ``plain`` takes ASCII punctuation for white space."""
    data = (text or "").encode("utf-8", "replace").lower()
    return (data.translate(PLAIN) if plain else data).split()


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order, repeats included.

    Fewer words than ``n`` make one shingle of the whole sequence; no words make none.
    """
    n = min(n, len(hashes))
    if n == 0:
        return np.empty(0, np.uint64)
    last = len(hashes) - n + 1
    found = np.full(last, n, np.uint64)
    for k in range(n):
        found = found * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + last]
    return splitmix(found)


class CirculantMinHash:
    """Min-wise hashes from two permutations of the 32-bit numbers.

    The first permutation is applied to a set's elements once.  The second one, shifted
    by k places around the circle of 32-bit numbers, gives coordinate k of the signature.
    """

    SLICE = 1 << 15  # elements at a time: they stay in the processor's cache

    def __init__(self, size: int) -> None:
        self.size = size

    @staticmethod
    def first(elements: np.ndarray) -> np.ndarray:
        """Elements (64-bit hashes) at their places on the circle."""
        x = (elements ^ (elements >> np.uint64(32))).astype(np.uint32)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
        return x ^ (x >> np.uint32(15))

    @staticmethod
    def second(x: np.ndarray, shift: int) -> np.ndarray:
        """The second permutation at ``x``, shifted ``shift`` places."""
        y = x + np.uint32(shift)
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x85EBCA6B)
        y ^= y >> np.uint32(13)
        y *= np.uint32(0xC2B2AE35)
        y ^= y >> np.uint32(16)
        return y

    def signatures(self, elements: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of ``size`` minima per run of elements; ``starts`` are the runs' beginnings."""
        found = np.full((len(starts), self.size), 0xFFFFFFFF, np.uint32)
        for lo in range(0, len(elements), self.SLICE):
            x = self.first(elements[lo : lo + self.SLICE])
            a = max(0, int(np.searchsorted(starts, lo, "right")) - 1)
            b = int(np.searchsorted(starts, lo + len(x), "left"))
            at = np.maximum(starts[a:b] - lo, 0)
            for k in range(self.size):
                least = np.minimum.reduceat(self.second(x, k), at)
                found[a:b, k] = np.minimum(found[a:b, k], least)
        return found


def bands(threshold: float, miss: float = 1e-6, rows: int = 5) -> int:
    """How many bands of ``rows`` coordinates let a pair at the threshold slip with chance ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold**rows)))


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    n, size = signatures.shape
    cells = signatures.reshape(n, size // rows, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, size // rows + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for k in range(rows):
        keys = splitmix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
    return keys


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000


def in_batches(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with at most ``BATCH_ROWS`` rows at a time.

    Texts may be long, and both the executor and its Python worker hold a batch whole.
    The session's setting is lowered to that and stays so, as plans run later.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_ROWS)) <= BATCH_ROWS:
        conf.set(_BATCH_ROWS, str(BATCH_ROWS))
    owner = function.__module__

    def task(batches):
        take_over(owner)
        yield from function(batches)

    return df.mapInArrow(task, schema)


def groups(texts: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of about ``most`` characters, with the place of the first one."""
    found, first, size = [], 0, 0
    for k, text in enumerate(texts):
        found.append(text.as_py())
        size += len(found[-1] or "")
        if size >= most:
            yield first, found
            found, first, size = [], k + 1, 0
    if found:
        yield first, found


def once(column: Column) -> Column:
    """A costly column that filters on it, or on what is made of it, do not compute again.

    Spark moves filters below deterministic columns by copying their expressions, which
    multiplies the work of nested ones.  The condition is always true; it only keeps that
    from happening.
    """
    return F.when(F.spark_partition_id() >= 0, column)
