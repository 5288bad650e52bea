"""Token counts of flat token files without an index (operator 6).

A flat file is nothing but ids, one document after another, each ended by a separator id.
It is read in blocks that know nothing of documents.  Each block is searched for
separators at once (a numpy comparison); a prefix scan over one summary row per block
(ids, separators, place of the last separator) then gives every block the position it
begins at, how many documents ended before it and where the last of them did, which
stitches documents over any number of blocks.  The scan runs inside groups of blocks and
then over groups, so a single huge file is not summed up in one task.

Files are kept as a Parquet folder of blocks, or read from binary files as they are.  Of
those only names and lengths are listed; each task then reads its own slices of a file.

Defined cases: two separators in a row hold an empty document between them (count 0).
Ids after the last separator are one document more, ``ended`` false.  An empty file has
no documents.  Files without separators are one document that did not end.  A binary
file whose length is no multiple of an id's fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.op1_token_shards import Encoder, encoded
from wardline.llm.words import in_batches

BLOCK_IDS = 1 << 16
SLICE_BLOCKS = 1 << 9  # blocks of a binary file in a slice: 64 MB of two-byte ids
MOST_TASKS = 50_000  # that read slices; with more slices than that, a task reads several
GROUP = 1 << 12  # blocks scanned together

FLAT = "file string, block long, ids binary, doc_ids array<long>"
FOUND = "file string, block long, n_ids long, separators array<long>"


def write_flat(
    docs: DataFrame, path: str, encoder: Callable[[], Encoder], separator: int, kind: str = "<u2",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``docs`` (doc_id, text) to flat files, one per task, in the order they come.

    Texts stay where they are read.  ``doc_ids`` of a block lists the documents that begin in it or after the block before;
    the scan does not read them.  An id that ``kind`` cannot hold fails the job: cut short, it could pass for a separator.
    """

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, file, most = encoder(), f"{TaskContext.get().partitionId():08d}", np.iinfo(kind).max
        held, size, block, begun = [], 0, 0, []

        def row(ids: np.ndarray) -> pa.RecordBatch:
            values = ([file], [block], [ids.astype(kind).tobytes()], [begun])
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["file", "block", "ids", "doc_ids"])

        for batch in batches:
            for doc_id, ids in encoded(batch, encode):
                ids = np.append(ids, np.uint32(separator))
                if ids.max() > most:
                    raise ValueError(f"id {ids.max()} of document {doc_id} does not fit {kind}")
                begun.append(doc_id)
                held.append(ids)
                size += len(ids)
                if size >= block_ids:
                    stream = np.concatenate(held)
                    whole = size - size % block_ids
                    for at in range(0, whole, block_ids):
                        yield row(stream[at : at + block_ids])
                        block, begun = block + 1, []
                    held, size = [stream[whole:]], size - whole
        if size or begun:
            yield row(np.concatenate(held))

    blocks = docs.select("doc_id", "text").transform(in_batches, flat, FLAT)
    blocks.write.option("compression", "zstd").parquet(path)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """Blocks (file, block, ids) of a folder that ``write_flat`` wrote."""
    return spark.read.schema(FLAT).parquet(path).select("file", "block", "ids")


def open_uri(uri: str) -> pa.NativeFile:
    """A file to read at any place.  For file systems that pyarrow knows (local, HDFS, S3, GCS)."""
    scheme, _, rest = uri.partition(":")
    place = rest if rest.startswith("//") else f"//{rest}"  # Spark writes file:/path, without escapes
    system, path = fs.FileSystem.from_uri(f"{scheme}:{quote(place, safe='/:@')}")
    return system.open_input_file(path)


def read_binary(
    spark: SparkSession, path: str, kind: str = "<u2", block_ids: int = BLOCK_IDS, slice_blocks: int = SLICE_BLOCKS,
    open_file: Callable[[str], pa.NativeFile] = open_uri,
) -> DataFrame:
    """Blocks of raw binary files of any length, read in slices of ``slice_blocks`` blocks.

    Spark lists the files and deals their slices to tasks, so a large file is read by many.
    ``open_file`` opens a file by its URI, in a task; give one for other file systems.
    """
    width = np.dtype(kind).itemsize
    step = block_ids * width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, first in zip(*(c.to_pylist() for c in batch.columns)):
                if length % width:
                    raise ValueError(f"{file}: {length} bytes are no whole number of ids of {width} bytes")
                with open_file(file) as source:
                    source.seek(first * step)
                    for block in range(first, min(first + slice_blocks, -(-length // step))):
                        ids = source.read(min(step, length - block * step))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([file]), pa.array([block], pa.int64()), pa.array([ids], pa.binary())],
                            names=["file", "block", "ids"],
                        )

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "length")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {step}"), F.lit(slice_blocks).cast("long")))
    slices = files.select("path", "length", first.alias("first"))
    # A number of tasks that adaptive execution keeps: it would join these few bytes into one task.
    tasks = max(1, min(slices.count(), MOST_TASKS))
    return slices.repartition(tasks, "path", "first").transform(in_batches, cut, "file string, block long, ids binary")


def find_separators(blocks: DataFrame, separator: int, kind: str = "<u2") -> DataFrame:
    """Per block its number of ids and the places of separators in it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b.as_buffer(), kind) for b in batch.column(2)]
            places = [np.flatnonzero(x == separator) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(places, pa.list_(pa.int64())),
                ],
                names=["file", "block", "n_ids", "separators"],
            )

    return blocks.select("file", "block", "ids").transform(in_batches, search, FOUND)


def prefix_scan(found: DataFrame) -> DataFrame:
    """Adds to each block what comes before it in its file: ids (``base``), separators
    (``ended``) and the position of the last separator (``last_end``, -1: none)."""
    group = F.floor(F.col("block") / GROUP).alias("group")
    within = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    zero, none = F.lit(0).cast("long"), F.lit(-1).cast("long")
    summary = found.select(
        "file", "block", group, "n_ids", F.size("separators").cast("long").alias("n"),
        F.when(F.size("separators") > 0, F.element_at("separators", -1)).alias("last"),
    )
    inner = summary.withColumn("base", F.coalesce(F.sum("n_ids").over(within), zero))
    inner = inner.withColumn("end", F.col("base") + F.col("last"))
    inner = inner.select(
        "file", "block", "group", "base", F.coalesce(F.sum("n").over(within), zero).alias("ended"),
        F.max("end").over(within).alias("last_end"),
        (F.col("base") + F.col("n_ids")).alias("ids_upto"), "n", "end",
    )
    totals = inner.groupBy("file", "group").agg(F.max("ids_upto").alias("ids"), F.sum("n").alias("n"), F.max("end").alias("end"))
    totals = totals.withColumn("g_base", F.coalesce(F.sum("ids").over(before), zero))
    totals = totals.withColumn("g_end", F.col("g_base") + F.col("end"))
    totals = totals.select(
        "file", "group", "g_base", F.coalesce(F.sum("n").over(before), zero).alias("g_ended"),
        F.coalesce(F.max("g_end").over(before), none).alias("g_last"),
    )
    return inner.join(totals, ["file", "group"]).select(
        "file", "block", (F.col("g_base") + F.col("base")).alias("base"), (F.col("g_ended") + F.col("ended")).alias("ended"),
        F.coalesce(F.col("g_base") + F.col("last_end"), F.col("g_last")).alias("last_end"),
    )


def token_counts(found: DataFrame) -> DataFrame:
    """Documents of flat files from their separators: (file, ordinal, start, n_tokens, ended).

    ``n_tokens`` leaves the separator out.  ``found`` should be written (it is read twice).
    """
    placed = found.join(prefix_scan(found), ["file", "block"])
    each = placed.select("file", "base", "ended", "last_end", "separators", F.posexplode("separators").alias("k", "at"))
    before = F.when(F.col("k") == 0, F.col("last_end")).otherwise(F.col("base") + F.get("separators", F.col("k") - 1))
    ended = each.select(
        "file", (F.col("ended") + F.col("k")).alias("ordinal"), (before + 1).alias("start"),
        (F.col("base") + F.col("at") - before - 1).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    last = placed.groupBy("file").agg(
        F.max(F.col("base") + F.col("n_ids")).alias("ids"),
        F.max(F.col("ended") + F.size("separators")).alias("ordinal"),
        F.max(F.greatest("last_end", F.col("base") + F.element_at("separators", F.when(F.size("separators") > 0, F.lit(-1))))).alias("end"),
    )
    rest = last.filter(F.col("ids") > F.col("end") + 1).select(
        "file", "ordinal", (F.col("end") + 1).alias("start"), (F.col("ids") - F.col("end") - 1).alias("n_tokens"),
        F.lit(False).alias("ended"),
    )
    return ended.unionByName(rest)


def document_order(spark: SparkSession, path: str) -> DataFrame:
    """Which document is which: (file, ordinal, doc_id), from the ids noted while writing."""
    noted = spark.read.schema(FLAT).parquet(path).select("file", "block", "doc_ids")
    as_found = noted.select("file", "block", F.lit(0).cast("long").alias("n_ids"), F.col("doc_ids").alias("separators"))
    first = prefix_scan(as_found).select("file", "block", "ended")
    each = noted.select("file", "block", F.posexplode("doc_ids").alias("k", "doc_id"))
    return each.join(first, ["file", "block"]).select("file", (F.col("ended") + F.col("k")).alias("ordinal"), "doc_id")
