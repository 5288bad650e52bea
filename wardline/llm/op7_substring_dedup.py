"""Repeated passages by content-defined seeds with a gear rolling hash (operator 7).

The gear hash of a place depends on the bytes just before it.  Among every ``SPREAD``
neighbouring words the one whose end has the smallest hash closes a seed, which is that
word and the ones before it, ``SEED`` words with the white space between them.  So two
texts that share ``SEED + SPREAD - 1`` = ``MIN_WORDS`` words share a seed, wherever the
words stand and however short they are.  Seeds are compared by 64-bit digests: one
aggregation finds those that occur more than once and their first place, one join marks
the others.  Neighbouring seeds that agree with the same first document make a run, and
both edges of a run grow word by word, white space included, as long as the two texts
agree.  Runs of a document that touch make a passage, reported from ``MIN_WORDS`` words
on; a chance collision of digests is shorter than that.  What a passage holds of words
that occurred before is told apart from what occurs in it first, which is kept.

An edge grows by ``SPREAD`` words at most, since further shared words hold a seed of their
own.  Where that seed came first in a third document, the edge follows this one.

Words lie between ASCII white space.  A character of a script written without it (Han,
kana, Thai, Lao, Khmer, Burmese) is a word of its own.

Defined cases: null and empty texts have no words.  Repeated rows (same ``doc_id``, same
text) are one occurrence.  Different texts of one ``doc_id`` are parts of one document:
each has its own places, and ``part`` (a hash of the text, 0 for all other documents) says
which one a row is about.  Rows with a null ``doc_id`` cannot be named and are left out.
Other columns are ignored.  Texts are read in groups of bounded size; a single text is held
whole, as Spark holds its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wardline.llm.words import groups, in_batches, splitmix
from wardline.storage import materialize

MIN_WORDS = 24
SPREAD = MIN_WORDS // 2  # words one of which closes a seed
SEED = MIN_WORDS + 1 - SPREAD  # words of a seed: more than SPREAD, so that seeds of a passage touch

_GEAR = splitmix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)
_GEAR[0] = 0  # the byte between texts adds nothing
_WINDOW = 16  # bytes that a gear hash sees

# First two UTF-8 bytes (from, to) of the scripts without white space between words.
_UNSPACED = [
    (0xE0B8, 0xE0BB),  # Thai, Lao
    (0xE180, 0xE182),  # Burmese
    (0xE19E, 0xE19F),  # Khmer
    (0xE381, 0xE9BF),  # kana, Han
    (0xEFA4, 0xEFAB),  # Han, compatibility
    (0xF0A0, 0xF0BF),  # Han, extensions
]

_SPLIT = b"\xff"  # a byte that UTF-8 never holds

SEEDS = "doc_id long, part long, word int, digest long"
FIRSTS = (
    "first_doc_id long, first_part long, first_word int, first_stop int, first_start int, first_end int, "
    "left binary, right binary"
)
RANGES = "doc_id long, part long, start long, end long, word int, stop int, copied boolean, first_doc_id long"
PASSAGES = "doc_id long, part long, start long, end long, n_words long, n_copied long, first_doc_id long, kept boolean"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: gear values of the last bytes, each shifted by its distance."""
    h = _GEAR[data]
    width = 1
    while width < _WINDOW:
        h[width:] += h[:-width].copy() << np.uint32(width)
        width *= 2
    return h


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of words in UTF-8 bytes that begin and end with a blank or zero byte."""
    blank = (data == 32) | ((data >= 9) & (data <= 13)) | (data == 0)
    begins, ends = np.zeros(len(data), bool), np.zeros(len(data), bool)
    begins[1:] = blank[:-1] & ~blank[1:]
    ends[1:] = ~blank[:-1] & blank[1:]
    leads = np.flatnonzero(data >= 0xE0)
    pairs = (data[leads].astype(np.int32) << 8) | data[np.minimum(leads + 1, len(data) - 1)]
    own = leads[np.any([(pairs >= low) & (pairs <= high) for low, high in _UNSPACED], axis=0)]
    if len(own):
        behind = own + np.where(data[own] >= 0xF0, 4, 3)
        ends[own] |= ~blank[own - 1]
        begins[behind] |= ~blank[behind]
        begins[own] = ends[behind] = True
    return np.flatnonzero(begins), np.flatnonzero(ends)


def seed_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and digest of every seed."""
    gap = b"\0" * _WINDOW
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    lengths = np.array([len(e) for e in encoded], np.int64)
    begins = np.cumsum(lengths + len(gap)) - lengths
    joined = gap + gap.join(encoded) + gap
    data = np.frombuffer(joined, np.uint8)
    starts, ends = word_places(data)
    if len(starts) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)
    owner = np.searchsorted(begins, starts, "right") - 1
    place = np.arange(len(starts)) - np.searchsorted(owner, owner)
    near = np.lib.stride_tricks.sliding_window_view(gear_hashes(data)[ends - 1], SPREAD)
    first = np.arange(len(near))
    whole = (place[first] >= SEED - 1) & (owner[first] == owner[first + SPREAD - 1])
    last = np.unique((first + near.argmin(axis=1))[whole])
    word = last - (SEED - 1)
    digests = b"".join([xxhash.xxh3_64_digest(joined[a:b]) for a, b in zip(starts[word].tolist(), ends[last].tolist())])
    return owner[last], place[word].astype(np.int32), np.frombuffer(digests, ">i8").astype(np.int64)


def _named(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")


def shared_ids(docs: DataFrame) -> DataFrame:
    """Ids of more than one text, written: (doc_id)."""
    code = F.xxhash64("text")
    of_id = _named(docs).filter(F.col("text").isNotNull()).groupBy("doc_id").agg(F.min(code).alias("least"), F.max(code).alias("most"))
    return materialize(of_id.filter("least < most").select("doc_id"), "shared_ids")


def _with_part(df: DataFrame, shared: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """``df`` with ``part``: which of the texts of one id a row holds."""
    ids = shared.select(F.col("doc_id").alias("_shared_id"))
    part = F.when(F.col("_shared_id").isNotNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))
    return df.join(ids, doc_id.cast("long") == F.col("_shared_id"), "left").withColumn("part", part).drop("_shared_id")


def _texts(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """Documents with a text: (doc_id, part, text)."""
    texts = _named(docs).filter(F.col("text").isNotNull())
    return _with_part(texts, shared, F.col("doc_id"), F.col("text")).select("doc_id", "part", "text")


def seeds(texts: DataFrame) -> DataFrame:
    """Every seed of every text (doc_id, part, text): (doc_id, part, word, digest)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SEEDS.split(", ")]
        for batch in batches:
            ids, parts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for first, group in groups(batch.column(2)):
                doc, *columns = seed_texts(group)
                own = [pa.array(ids[first + doc], pa.int64()), pa.array(parts[first + doc], pa.int64())]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, columns)], names=names)

    return texts.transform(in_batches, find, SEEDS)


PLACE = ["first_doc_id", "first_part", "first_word", "first_stop"]


def repeated_runs(texts: DataFrame, across: bool = True) -> DataFrame:
    """Runs of seeds that occurred before, with their first place: (doc_id, part, word, stop, first_doc_id, first_part, first_word, first_stop).

    ``across``: only seeds that two documents hold; else repeats inside a document as well.
    Seeds are found twice, once for each side of the join: they take more room than texts.
    """
    every = seeds(texts)
    held = every.groupBy("digest").agg(
        F.min(F.struct("doc_id", "part", "word")).alias("first"), F.max(F.struct("doc_id", "part", "word")).alias("last")
    )
    several = F.col("first.doc_id") < F.col("last.doc_id") if across else F.col("first") < F.col("last")
    held = held.filter(several).select("digest", *(F.col(f"first.{c}").alias(f"first_{c}") for c in ("doc_id", "part", "word")))
    here, there = (F.struct(*(F.col(f"{side}{c}").alias(c) for c in ("doc_id", "part", "word"))) for side in ("", "first_"))
    along = Window.partitionBy("doc_id", "part").orderBy("word")
    shift = F.col("word") - F.col("first_word")
    goes_on = (
        (F.col("first_doc_id") == F.lag("first_doc_id").over(along)) & (F.col("first_part") == F.lag("first_part").over(along))
        & (shift == F.lag(shift).over(along)) & (F.col("word") <= F.lag("word").over(along) + SEED)
    )
    marked = (
        every.join(held, "digest").filter(here != there).dropDuplicates(["doc_id", "part", "word"])
        .withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(along))
    )
    runs = marked.groupBy("doc_id", "part", "run").agg(
        F.min("word").alias("word"), (F.max("word") + SEED).alias("stop"), F.min("first_doc_id").alias("first_doc_id"),
        F.min("first_part").alias("first_part"), F.min("first_word").alias("first_word"),
    )
    first_stop = (F.col("first_word") + F.col("stop") - F.col("word")).alias("first_stop")
    return runs.select("doc_id", "part", "word", "stop", "first_doc_id", "first_part", "first_word", first_stop)


class Words:
    """The words of a text, their bytes and places in code points."""

    def __init__(self, text: str) -> None:
        self.data = b" " + text.encode("utf-8", "replace") + b" "
        data = np.frombuffer(self.data, np.uint8)
        starts, ends = word_places(data)
        self.starts, self.ends = starts.tolist(), ends.tolist()
        self.points = np.cumsum((data & 0xC0) != 0x80) - 2

    def __len__(self) -> int:
        return len(self.starts)

    def places(self, word: int, stop: int) -> tuple[int, int]:
        return int(self.points[self.starts[word]]), int(self.points[self.ends[stop - 1]])

    def sides(self, word: int, stop: int) -> tuple[bytes, bytes]:
        """The words before ``word`` and from ``stop`` on, as many as an edge may grow by.

        Nearest first, each with the white space between it and the run, split by ``_SPLIT``.
        """
        data, starts, ends = self.data, self.starts, self.ends
        left = [data[starts[k] : starts[k + 1]] for k in range(word - 1, max(word - SPREAD, 0) - 1, -1)]
        right = [data[ends[k - 1] : ends[k]] for k in range(stop, min(stop + SPREAD, len(ends)))]
        return _SPLIT.join(left), _SPLIT.join(right)


def firsts_of(text: str, asked: list[dict]) -> list[tuple]:
    """Places and surroundings of runs of words."""
    words = Words(text)
    spans = [(a["first_word"], a["first_stop"]) for a in asked]
    return [(*span, *words.places(*span), *words.sides(*span)) for span in spans]


def agreeing(a: bytes, b: bytes) -> tuple[int, int]:
    """How many words of two sides agree from the nearest on, and their code points."""
    n = points = 0
    if a and b:
        for x, y in zip(a.split(_SPLIT), b.split(_SPLIT)):
            if x != y:
                break
            n, points = n + 1, points + len(x.decode())
    return n, points


def ranges_of(text: str, doc_id: int, part: int, runs: list[dict]) -> list[tuple]:
    """Runs of a document grown at both edges, and the same of their first places."""
    words, found = Words(text), []
    for r in runs:
        left, right = words.sides(r["word"], r["stop"])
        more_left, before = agreeing(left, r["left"])
        more_right, behind = agreeing(right, r["right"])
        start, end = words.places(r["word"], r["stop"])
        found.append((doc_id, part, start - before, end + behind, r["word"] - more_left, r["stop"] + more_right, True, r["first_doc_id"]))
        found.append((
            r["first_doc_id"], r["first_part"], r["first_start"] - before, r["first_end"] + behind,
            r["first_word"] - more_left, r["first_stop"] + more_right, False, r["first_doc_id"],
        ))
    return found


def _rows(df: DataFrame, function: Callable[..., list[tuple]], ddl: str) -> DataFrame:
    """The rows that ``function`` makes of the columns of each row."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for values in zip(*batch.columns) for r in function(*(v.as_py() for v in values))]
            columns = list(zip(*rows)) or [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.transform(in_batches, find, schema)


def shared_ranges(docs: DataFrame, across: bool = True) -> DataFrame:
    """Ranges that occurred before and, with ``copied`` false, where they did: (doc_id, part, start, end, word, stop, copied, first_doc_id)."""
    texts = _texts(docs, shared_ids(docs))
    runs = materialize(repeated_runs(texts, across), "runs")
    asked = runs.select(*PLACE).distinct().groupBy(F.col("first_doc_id").alias("doc_id"), F.col("first_part").alias("part")).agg(
        F.collect_list(F.struct("first_word", "first_stop")).alias("asked")
    )
    firsts = _rows(
        texts.join(asked, ["doc_id", "part"]).select("doc_id", "part", "text", "asked"),
        lambda doc_id, part, text, asked: [(doc_id, part, *r) for r in firsts_of(text, asked)], FIRSTS,
    ).dropDuplicates(PLACE)
    listed = runs.join(firsts, PLACE).groupBy("doc_id", "part").agg(
        F.collect_list(F.struct("word", "stop", *PLACE, "first_start", "first_end", "left", "right")).alias("runs")
    )
    return _rows(texts.join(listed, ["doc_id", "part"]).select("text", "doc_id", "part", "runs"), ranges_of, RANGES).distinct()


def joined_ranges(ranges: list[dict], min_words: int) -> list[tuple]:
    """Rows of one text from its ranges: (start, end, n_words, n_copied, first_doc_id, kept)."""
    passages: list[list[dict]] = []
    stop = -1
    for r in sorted(ranges, key=lambda r: (r["word"], r["stop"])):
        if r["word"] > stop:
            passages.append([])
        passages[-1].append(r)
        stop = max(stop, r["stop"])
    found = []
    for held in passages:
        n_words = max(r["stop"] for r in held) - held[0]["word"]
        if n_words < min_words:
            continue
        copied: list[dict] = []
        for r in held:
            if r["copied"] and copied and r["word"] <= copied[-1]["stop"]:
                last = copied[-1]
                copied[-1] = last | {k: max(last[k], r[k]) for k in ("stop", "end")} | {"first_doc_id": min(last["first_doc_id"], r["first_doc_id"])}
            elif r["copied"]:
                copied.append(r)
        ends = {"word": held[0]["word"] + n_words, "start": max(r["end"] for r in held)}
        here = [r["first_doc_id"] for r in held if not r["copied"]]
        word, start = held[0]["word"], held[0]["start"]
        for r in [*copied, ends]:
            if r["word"] > word:
                found.append((start, r["start"], n_words, 0, min(here), True))
            if r is not ends:
                found.append((r["start"], r["end"], n_words, r["stop"] - r["word"], r["first_doc_id"], False))
                word, start = r["stop"], r["end"]
    return found


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, across: bool = True) -> DataFrame:
    """Passages that documents share: (doc_id, part, start, end, n_words, n_copied, first_doc_id, kept).

    Texts without one have no row.  Places are code points.  A passage has a row for each
    part that occurred before (in a document with a smaller id, or further up), with its
    words as ``n_copied``, and a ``kept`` row for each part that occurs here first.
    ``n_words`` counts the words of the whole passage, in every row of it.  So of all
    words that are not kept, the same words stay where they occurred first.
    """
    held = shared_ranges(docs, across).groupBy("doc_id", "part").agg(
        F.collect_list(F.struct("start", "end", "word", "stop", "copied", "first_doc_id")).alias("ranges")
    )
    return _rows(held, lambda doc_id, part, ranges: [(doc_id, part, *r) for r in joined_ranges(ranges, min_words)], PASSAGES)


def without_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the passages that are not kept cut out of their texts; all columns as they were."""
    spans = passages.filter(~F.col("kept")).groupBy("doc_id", "part").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    joined = _with_part(rows, shared_ids(docs), F.col("doc_id"), F.col("row.text")).join(spans, ["doc_id", "part"], "left")
    text = F.col("row.text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    folded = F.aggregate(
        "spans", start,
        lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"])).alias("out")),
    )
    cut = F.concat(folded["out"], F.substr(text, folded["at"] + 1))
    return joined.select(
        *(F.col(f"row.{c}") if c != "text" else F.when(F.col("spans").isNull(), text).otherwise(cut).alias("text") for c in docs.columns)
    )
