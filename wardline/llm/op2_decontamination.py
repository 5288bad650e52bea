"""Benchmark items inside documents, by size-partitioned MinHash containment search (operator 2).

A short item and a long document have little in common as sets, so sizes are matched
first.  Items are partitioned by the size of their shingle set, and for each size class
documents are cut to blocks of about that size.  An item of which a document holds four
fifths then shares, over all blocks, at least about a quarter of the coordinates of its
signature with one block or another, however its shingles are spread; one shared
coordinate makes a candidate (with 64 of them a miss has a chance below 1e-6).
Candidates are decided by exact containment of the item's set in the document's set.

Items are split and hashed in tasks.  Documents are never shuffled: the items' sets and
signatures go to every task, at most ``BLOCK_SHINGLES`` shingles of them at a time.  More
items than that are searched in several passes over the documents, one per block of items.

An item with fewer words than a shingle is looked up as it is: each of its lengths makes
one more pass of hashes over a document's words, and equal runs are found by bisection.

Words are lower-cased (A-Z) and ASCII punctuation counts as white space.  Defined cases:
null and word-free texts and items match nothing.  An item with fewer words than a
shingle is one shingle, found wherever its words stand together; such words may be common
language, so ``without_contaminated`` removes documents for them only if asked.  Equal
items are reported each.  Rows are searched as they come, repeated ones too; a null
``doc_id`` is reported as null.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import CirculantMinHash, WordHashes, groups, in_batches, shingle_hashes, splitmix, word_hashes, words_of

WORDS, PERCENT = 5, 80
SEPARATORS = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"  # the same words for SQL
COORDINATES = 64
BLOCK_SHINGLES = 2_000_000
FILTER_BITS = 22

SETS = "item_id long, short int, shingles binary"
FOUND = "doc_id long, item_id long, n_shared long, n_item_shingles long, containment double"


class Item(NamedTuple):
    """An item's distinct shingles.  ``short``: its number of words, if those are fewer than a shingle's (else 0)."""

    id: int | None
    shingles: np.ndarray
    short: int = 0


def item_of(item_id: int | None, text: str | None, hashes: WordHashes, words: int) -> Item:
    found = hashes.of(words_of(text, plain=True))
    return Item(item_id, np.unique(shingle_hashes(found, words)), len(found) if len(found) < words else 0)


def _cell(values: np.ndarray, coordinate: int) -> np.ndarray:
    """A coordinate's value as one number that also says which coordinate it is."""
    return (np.uint64(coordinate) << np.uint64(32)) | values.astype(np.uint64)


def _slot(cells: np.ndarray) -> np.ndarray:
    return splitmix(cells) >> np.uint64(64 - FILTER_BITS)


@dataclass(frozen=True)
class SizeClass:
    """Items of up to ``size`` shingles (and over half as many): where their coordinates lead."""

    size: int
    present: np.ndarray  # which slots of a fixed-size filter any coordinate falls in
    cells: np.ndarray  # sorted coordinates
    items: np.ndarray  # the item of each


@dataclass(frozen=True)
class Index:
    """One block of items: their sets, and their signatures by size class, small sizes first."""

    ids: list[int]
    sets: list[np.ndarray]
    classes: list[SizeClass]
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by number of words: sorted hashes, the item of each


def build_index(items: list[Item]) -> Index:
    minhash = CirculantMinHash(COORDINATES)
    by_size: dict[int, list[int]] = defaultdict(list)
    by_words: dict[int, list[int]] = defaultdict(list)
    for k, item in enumerate(items):
        if item.short:
            by_words[item.short].append(k)
        else:
            by_size[1 << max(0, len(item.shingles) - 1).bit_length()].append(k)
    classes = []
    for size, members in sorted(by_size.items()):
        lengths = np.array([len(items[k].shingles) for k in members])
        signatures = minhash.signatures(np.concatenate([items[k].shingles for k in members]), np.cumsum(lengths) - lengths)
        cells = np.concatenate([_cell(signatures[:, c], c) for c in range(COORDINATES)])
        order = np.argsort(cells, kind="stable")
        present = np.zeros(1 << FILTER_BITS, bool)
        present[_slot(cells)] = True
        classes.append(SizeClass(size, present, cells[order], np.tile(np.array(members), COORDINATES)[order]))
    short = {}
    for n, members in by_words.items():
        values = np.concatenate([items[k].shingles for k in members])
        order = np.argsort(values, kind="stable")
        short[n] = values[order], np.array(members)[order]
    return Index([i.id for i in items], [i.shingles for i in items], classes, short)


def _candidates(shingles: np.ndarray, owner: np.ndarray, starts: np.ndarray, index: Index) -> set[tuple[int, int]]:
    """(document, item) pairs that share a coordinate; ``starts`` are the documents' first shingles."""
    found: set[tuple[int, int]] = set()
    minhash = CirculantMinHash(COORDINATES)
    step = minhash.SLICE
    sizes = [c.size for c in index.classes]
    for lo in range(0, len(shingles), step):
        x = minhash.first(shingles[lo : lo + step])
        own = owner[lo : lo + step]
        begins = starts[(starts > lo) & (starts < lo + len(x))] - lo
        # Blocks of the smallest class; those of larger ones are made of them.
        base = sizes[0]
        edges = np.union1d(np.arange(0, len(x), base), begins)
        levels, places = [], edges
        for size in sizes:
            every = np.union1d(np.arange(0, len(x), size), begins)
            levels.append((np.searchsorted(edges, every), own[every]))
        for c in range(COORDINATES):
            least = np.minimum.reduceat(minhash.second(x, c), places)
            for of_size, (blocks, docs) in zip(index.classes, levels):
                cells = _cell(np.minimum.reduceat(least, blocks), c)
                hits = np.flatnonzero(of_size.present[_slot(cells)])
                if not len(hits):
                    continue
                a = np.searchsorted(of_size.cells, cells[hits], "left")
                b = np.searchsorted(of_size.cells, cells[hits], "right")
                for doc, i, j in zip(docs[hits].tolist(), a.tolist(), b.tolist()):
                    found.update((doc, item) for item in of_size.items[i:j].tolist())
    return found


def _short_items(found: list[np.ndarray], index: Index) -> Iterator[tuple[int, int]]:
    """(text, item) wherever the words of a short item stand together; ``found`` are the texts' word hashes."""
    for n, (values, members) in sorted(index.short.items()):
        for doc, hashes in enumerate(found):
            if len(hashes) < n:
                continue
            runs = np.unique(shingle_hashes(hashes, n))
            a, b = np.searchsorted(values, runs, "left"), np.searchsorted(values, runs, "right")
            for k in np.flatnonzero(b > a).tolist():
                yield from ((doc, item) for item in members[a[k] : b[k]].tolist())


def find_items(texts: list[str | None], index: Index, hashes: WordHashes, words: int, percent: int):
    """(place of the text, place of the item, shared shingles) wherever an item is contained."""
    found = [hashes.of(words_of(t, plain=True)) for t in texts]
    for doc, item in _short_items(found, index):
        yield doc, item, 1
    runs = [shingle_hashes(f, words) for f in found]
    lengths = np.array([len(r) for r in runs], np.int64)
    if not lengths.sum() or not index.classes:
        return
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(texts)), lengths)
    by_doc: dict[int, list[int]] = defaultdict(list)
    for doc, item in sorted(_candidates(np.concatenate(runs), owner, starts[lengths > 0], index)):
        by_doc[doc].append(item)
    for doc, candidates in by_doc.items():
        whole = np.unique(runs[doc])
        for item in candidates:
            wanted = index.sets[item]
            at = np.minimum(np.searchsorted(whole, wanted), len(whole) - 1)
            shared = int((whole[at] == wanted).sum())
            if 100 * shared >= percent * len(wanted):
                yield doc, item, shared


def item_sets(items: DataFrame, words: int = WORDS) -> DataFrame:
    """Items (item_id, text) that have words, as shingle sets."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in groups(batch.column(1)):
                made = [item_of(ids[first + k], text, word_hashes(), words) for k, text in enumerate(texts)]
                made = [item for item in made if len(item.shingles)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i.id for i in made], pa.int64()), pa.array([i.short for i in made], pa.int32()),
                        pa.array([i.shingles.tobytes() for i in made], pa.binary()),
                    ],
                    names=["item_id", "short", "shingles"],
                )

    return items.select(F.col("item_id").cast("long"), "text").transform(in_batches, hashed, SETS)


def item_blocks(items: DataFrame, words: int = WORDS, short: bool = True) -> Iterator[list[Item]]:
    """Items as shingle sets, in blocks of bounded size.  ``short``: with items of fewer words than a shingle."""
    block, size = [], 0
    sets = item_sets(items, words)
    for item_id, n, shingles in (sets if short else sets.filter("short = 0")).toLocalIterator():
        block.append(Item(item_id, np.frombuffer(bytes(shingles), np.uint64), n))
        size += len(block[-1].shingles)
        if size >= BLOCK_SHINGLES:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Pairs (doc_id, item_id, ...) with ``100 * shared >= percent * item's shingles``."""
    spark = docs.sparkSession

    def search(block: list[Item]) -> DataFrame:
        shared_index = spark.sparkContext.broadcast(build_index(block))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, index = word_hashes(), shared_index.value
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                for first, texts in groups(batch.column(1)):
                    for doc, item, shared in find_items(texts, index, hashes, words, percent):
                        n = len(index.sets[item])
                        rows.append((ids[first + doc], index.ids[item], shared, n, shared / n))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "n_shared", "n_item_shingles", "containment"],
                )

        return docs.select(F.col("doc_id").cast("long"), "text").transform(in_batches, look, FOUND)

    parts = [search(block) for block in item_blocks(items, words)]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], FOUND)


def without_contaminated(
    docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = PERCENT, short: bool = False
) -> DataFrame:
    """The rows that contain no item; all columns as they were.  Searched once, nothing is shuffled.

    ``short``: items of fewer words than a shingle count too.
    """
    text = docs.columns.index("text")

    def clean(df: DataFrame, block: list[Item]) -> DataFrame:
        shared_index = df.sparkSession.sparkContext.broadcast(build_index(block))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in groups(batch.column(text)):
                    for doc, _, _ in find_items(texts, shared_index.value, word_hashes(), words, percent):
                        keep[first + doc] = False
                yield batch.filter(pa.array(keep))

        return df.transform(in_batches, look, df.schema)

    return reduce(clean, item_blocks(items, words, short), docs)
