"""Near-duplicate documents by circulant MinHash (operator 3).

1. Each text becomes its set of word shingles.  Two permutations, one of them shifted
   around the circle, give all signature coordinates, which are cut to bands.
2. Documents with equal sets form a class; from here on one document speaks for it.
3. Classes that share a band meet in its bucket.  They are not paired there: every class
   is compared with the smallest one it meets in any bucket, on full sets.
4. Links found make components.  Only buckets that still hold several components need
   more: small ones compare classes of different components; in large ones, classes first
   have to meet under a rare shingle at places and sizes that still allow a link (which
   no pair above the threshold lacks).  So a group of copies costs one comparison per
   class, and neither a passage that many texts share nor copies that drifted too far
   apart cost all their pairs.
5. Every link decides on ``100 * intersection >= percent * union`` of full sets.

A pair at the threshold is missed with a chance of 1e-6 (more alike pairs with less);
that chance fixes the number of bands.

Defined cases: null, empty or blank texts have an empty set, are linked with nothing and
are kept.  Fewer words than a shingle make one shingle of the whole sequence.  Rows with a
null ``doc_id`` cannot be named: they get a null component, are kept and link nothing.
Repeated rows share their id and so their component.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.words import (
    CirculantMinHash,
    WordHashes,
    band_keys,
    bands,
    groups,
    in_batches,
    shingle_hashes,
    word_hashes,
    words_of,
)
from wardline.storage import materialize

ROWS_PER_BAND = 5
SMALL_BUCKET = 8  # classes; above, early shingles must be shared before two classes are compared

SKETCH = "doc_id long, n_shingles long, set_hi long, set_lo long, band_keys array<long>"
SETS = "rep long, n_shingles long, shingles array<long>"
SET = ["set_hi", "set_lo"]


def _shingle_sets(texts: list[str | None], hashes: WordHashes, words: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(hashes.of(words_of(t)), words)) for t in texts]


def sketches(docs: DataFrame, words: int, n_bands: int) -> DataFrame:
    """Per row: size and 128-bit digest of its shingle set, and its band keys (none if empty)."""
    minhash = CirculantMinHash(n_bands * ROWS_PER_BAND)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            for first, texts in groups(batch.column(1)):
                sets = _shingle_sets(texts, hashes, words)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]]).astype(np.int64)
                elements = np.concatenate([np.empty(0, np.uint64), *sets])
                keys = band_keys(minhash.signatures(elements, starts), ROWS_PER_BAND) if len(full) else []
                found = np.empty(len(sets), object)
                for row, key in zip(full, keys):
                    found[row] = key.view(np.int64)
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s) for s in sets), ">i8").astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)).cast(pa.int64()),
                        pa.array(sizes),
                        pa.array(digests[::2]),
                        pa.array(digests[1::2]),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", *SET, "band_keys"],
                )

    return docs.select("doc_id", "text").transform(in_batches, sketch, SKETCH)


def class_sets(docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """The full shingle sets of the given documents (rep)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            for first, texts in groups(batch.column(1)):
                found = _shingle_sets(texts, hashes, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(found)).cast(pa.int64()),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                    ],
                    names=["rep", "n_shingles", "shingles"],
                )

    wanted = docs.select(F.col("doc_id").alias("rep"), "text").join(reps.select("rep"), "rep", "left_semi")
    return wanted.transform(in_batches, sets, SETS).dropDuplicates(["rep"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are alike enough.  Sizes are checked before sets are moved."""
    sizes = sets.select("rep", "n_shingles")
    small, large = F.least("nu", "nv"), F.greatest("nu", "nv")
    sized = (
        pairs.join(sizes.toDF("u", "nu"), "u").join(sizes.toDF("v", "nv"), "v")
        .filter(100 * small >= percent * large)
        .select("u", "v")
    )
    both = sized.join(sets.toDF("u", "nu", "su"), "u").join(sets.toDF("v", "nv", "sv"), "v")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "su", "sv").transform(in_batches, alike, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """The smallest member each linked node can reach: (node, label).

    Alternating large and small stars: every round hangs nodes on smaller neighbours until
    nothing changes, which takes a number of rounds logarithmic in the longest chain.
    """
    edges = materialize(links.select("u", "v").distinct(), "links")
    before = None
    while True:
        edges = _star(edges, large=True)
        edges = materialize(_star(edges, large=False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), v < u, after one star step at every node."""
    if large:
        seen = edges.union(edges.select("v", "u")).toDF("node", "other")
    else:
        seen = edges.toDF("node", "other")
    least = seen.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    joined = seen.join(least, "node")
    if large:
        moved = joined.filter(F.col("other") > F.col("node")).select(F.col("other").alias("u"), F.col("least").alias("v"))
    else:
        moved = joined.select(F.col("other").alias("u"), F.col("least").alias("v")).union(
            joined.select(F.col("node").alias("u"), F.col("least").alias("v"))
        )
    return moved.filter(F.col("v") < F.col("u")).distinct()


def _several(members: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Members (key, rep) with their labels, and the keys that still hold several labels."""
    if labels is None:
        labelled = members.withColumn("label", F.col("rep"))
    else:
        known = labels.toDF("rep", "known")
        labelled = members.join(known, "rep", "left").select("key", "rep", F.coalesce("known", "rep").alias("label"))
    keys = labelled.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.min("rep").alias("pivot"), F.count("*").alias("n")
    )
    return labelled, keys.filter(F.col("least") < F.col("most")).select("key", "pivot", "n")


def _cross(members: DataFrame) -> DataFrame:
    """Pairs (u, v) of one key with different labels, each once."""
    a = members.select("key", F.col("rep").alias("v"), F.col("label").alias("lv"))
    b = members.select("key", F.col("rep").alias("u"), F.col("label").alias("lu"))
    return b.join(a, "key").filter((F.col("v") < F.col("u")) & (F.col("lu") != F.col("lv"))).select("u", "v").distinct()


def _size_range(size: Column) -> Column:
    """Sizes in ranges whose ends differ by a fiftieth."""
    return F.floor(F.log(size.cast("double")) / math.log(1.02)).cast("int")


def _by_rare_shingles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of members (rep, label) with different labels that may be alike enough.

    Shingles are ordered by how many of these sets hold them, rare ones first.  Let two
    sets of m <= n shingles be alike enough, so that they share at least
    ``percent / (100 + percent) * (m + n)``.  The first one they share then comes early in
    both: so early in the smaller one that ``2 * percent / (100 + percent) * m`` follow, and
    in the larger one that enough follow for a partner of size m.  So each set is kept under
    its early shingles with its own size, and looked for under its early shingles with
    every range of sizes that the shingle's place still allows.
    """
    mine = sets.join(members.distinct(), "rep")
    each = mine.select("rep", "label", F.col("n_shingles").alias("n"), F.explode("shingles").alias("key"))
    held = each.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1")
    place = F.row_number().over(Window.partitionBy("rep").orderBy(F.coalesce("held", F.lit(1)), "key"))
    n, p = F.col("n"), F.col("p")
    early = n - F.ceil(n * percent / 100.0) + 1
    ranked = each.join(held, "key", "left").withColumn("p", place).filter((p <= early) & F.col("held").isNotNull())
    ranked = materialize(ranked.select("key", "rep", "label", "n", "p"), "ranked")
    kept = ranked.filter(p <= n - F.ceil(n * (2.0 * percent) / (100 + percent)) + 1).select(
        "key", _size_range(n).alias("range"), F.col("rep").alias("a"), F.col("label").alias("la"), n.alias("m"), p.alias("q")
    )
    least = F.ceil(n * percent / 100.0)
    most = F.least(n, F.floor((n - p + 1) * (100.0 + percent) / percent) - n)
    sought = ranked.withColumns({"least": least, "most": most}).filter("least <= most")
    sought = sought.withColumn("range", F.explode(F.sequence(_size_range(F.col("least")), _size_range(F.col("most")))))
    enough = (1 + F.least(F.col("m") - F.col("q"), n - p)) * (100 + percent) >= percent * (F.col("m") + n)
    # Labels meet first, so that members of one label, however many, never meet each other.
    here, there = kept.select("key", "range", "la").distinct(), sought.select("key", "range", "label").distinct()
    apart = there.join(here, ["key", "range"]).filter(F.col("la") != F.col("label"))
    met = sought.join(apart, ["key", "range", "label"]).join(kept, ["key", "range", "la"]).filter((F.col("m") <= n) & enough)
    return met.select(F.greatest("a", "rep").alias("u"), F.least("a", "rep").alias("v")).distinct()


def _labels(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Component of every class linked with another one: (node, label)."""
    every = classes.select(F.explode("band_keys").alias("key"), "rep")
    _, shared = _several(every, None)
    shared = materialize(shared.select("key", "pivot"), "buckets")
    members = materialize(every.join(shared, "key"), "members")
    sets = materialize(class_sets(docs, members.select("rep").distinct(), words), "sets")

    stars = members.groupBy(F.col("rep").alias("u")).agg(F.min("pivot").alias("v")).filter("v < u")
    links = materialize(verified(stars, sets, percent), "links")
    labels = components(links)

    labelled, keys = _several(members.select("key", "rep"), labels)
    left = materialize(labelled.join(keys, "key"), "left")
    pairs = _cross(left.filter(F.col("n") <= SMALL_BUCKET))
    large = left.filter(F.col("n") > SMALL_BUCKET)
    if not large.isEmpty():
        pairs = pairs.union(_by_rare_shingles(large.select("rep", "label"), sets, percent)).distinct()
    more = materialize(verified(pairs.join(stars, ["u", "v"], "left_anti"), sets, percent), "links")
    return labels if more.isEmpty() else components(links.union(more))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Every row's near-duplicate group: (doc_id, n_shingles, component_id, kept).

    Documents whose shingle sets have ``100 * intersection >= percent * union`` are linked;
    ``component_id`` is the smallest ``doc_id`` that links reach, and that document is kept.
    """
    found = materialize(sketches(docs, words, bands(percent / 100)), "sketches")
    named = found.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = named.groupBy(*SET).agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min_by("band_keys", "doc_id").alias("band_keys")
    )
    classes = materialize(classes, "classes")
    labels = _labels(docs, classes, words, percent)
    grouped = (
        classes.join(labels.toDF("rep", "label"), "rep", "left")
        .filter(F.col("label").isNotNull() | (F.col("copies") > 1))
        .select(*SET, F.coalesce("label", "rep").alias("group"))
    )
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("group", "doc_id")).otherwise(F.col("doc_id"))
    return (
        found.select("doc_id", "n_shingles", *SET)
        .join(grouped, SET, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, once each; all columns as they were."""
    dropped = near_duplicates(docs, words, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return _once(docs.join(dropped, "doc_id", "left_anti").select(docs.columns))


def _once(docs: DataFrame) -> DataFrame:
    """One row per ``doc_id``.  Only ids that occur more than once are touched, by a small join."""
    repeated = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id")
    again = materialize(repeated, "repeated")
    if again.isEmpty():
        return docs
    first = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return docs.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(first)
