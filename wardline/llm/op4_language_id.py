"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 4).

Training counts the hashed n-grams of labelled documents in Spark and sums them by
language and bucket; what reaches the driver is one number per language and bucket used
(at most ``BUCKETS`` a language).  The smoothed log-probability matrix is broadcast.  A
batch is scored as a sparse matrix product in numpy: the n-grams of a text are the columns
of its row, so its log-likelihoods are the sum of the matrix rows they name.

The score is the probability of the language against the others and against text whose
n-grams come by mere chance, so text unlike any language learned scores near 0.

``max_docs`` bounds the training sample per language.  It is drawn by a hash of the
``doc_id``, so reruns draw the same documents.  Prediction reads whole texts and nothing
but texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing could be learned (no labelled rows, an empty table).  Ties go to the
language that sorts first.  Rows are scored as they come, repeated ones too.  Other
columns are ignored.  Long texts are scored in slices of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import groups, in_batches

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_DOCS = 5_000
EVIDENCE = 64  # n-grams overlap and are not independent: a text counts as this many at most
UNKNOWN = "und"

_SPACE = np.uint32(32)
_SLICE = 1 << 18


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as one array of code points, each followed by a space; and their lengths."""
    lower = [(t or "").lower() + " " for t in texts]
    joined = "".join(lower)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    ascii_other = points < 128
    ascii_other &= ~((points >= 97) & (points <= 122))
    points[ascii_other] = _SPACE
    return points, np.array([len(t) for t in lower], np.int64)


def _buckets(points: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the ``n`` code points up to each place; spaces go before the first."""
    mixed = np.full(len(points), n, np.uint32)
    for back in range(n - 1, -1, -1):
        shifted = np.concatenate([np.full(min(back, len(points)), _SPACE), points[: max(0, len(points) - back)]])
        mixed = (mixed ^ shifted) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class Model:
    """Languages in order, and log probabilities of each bucket (a row) in each of them."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray

    def likelihoods(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the summed log probabilities by language, and how many n-grams it has."""
        points, lengths = _code_points(texts)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        margin = max(ORDERS) - 1
        for lo in range(0, len(points), _SLICE):
            piece = points[max(0, lo - margin) : lo + _SLICE]
            skip = min(lo, margin)
            a = int(np.searchsorted(starts, lo, "right")) - 1
            b = int(np.searchsorted(starts, lo + len(piece) - skip, "left"))
            at = np.maximum(starts[a:b] - lo, 0)
            for n in ORDERS:
                rows = self.matrix[_buckets(piece, n)[skip:]]
                total[a:b] += np.add.reduceat(rows, at, axis=0, dtype=np.float64)
        return total, lengths * len(ORDERS)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        total, counts = self.likelihoods(texts)
        weight = np.minimum(1.0, EVIDENCE / counts)[:, None]
        logits = total * weight + self.prior
        nothing = -math.log(BUCKETS) * counts[:, None] * weight  # n-grams by mere chance
        logits = np.hstack([logits, nothing])
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = np.argmax(total + self.prior, axis=1)
        return [
            (self.languages[k], float(chance[i, k])) if has_letter(texts[i]) else (UNKNOWN, 0.0)
            for i, k in enumerate(best)
        ]


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: ``crc32`` of the id's text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, max_docs: int) -> DataFrame:
    """Labelled documents that may be learned from, about ``max_docs`` a language at most."""
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    spread = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    small = F.broadcast(counts)  # one row per language
    return usable.join(small, "lang").filter(spread < F.lit(float(max_docs)) / F.col("n")).select("lang", "text")


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Fit on the ``text`` and ``lang`` of documents that are not held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                points, _ = _code_points([text.as_py()])
                for n in ORDERS:
                    for lo in range(0, len(points), _SLICE):
                        piece = points[max(0, lo - n + 1) : lo + _SLICE]
                        got = np.bincount(_buckets(piece, n)[min(lo, n - 1) :], minlength=BUCKETS)
                        seen[lang] = seen.get(lang, 0) + got
        for lang, counts in seen.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used])],
                names=["lang", "bucket", "n"],
            )

    counted = sample(docs, max_docs).transform(in_batches, count, "lang string, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    counts[rows["bucket"], rows["lang"].map({name: k for k, name in enumerate(languages)})] = rows["n"]
    smooth = counts + 0.5
    matrix = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    return Model(languages, np.full(len(languages), -math.log(max(1, len(languages)))), matrix)


def predictions(docs: DataFrame, model: Model, *columns: Column | str) -> DataFrame:
    """The given columns of every row with ``lang_pred`` and ``score``, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    asked = docs.select(F.col("text"), *columns)
    kept = asked.columns[1:]
    schema = ", ".join(f"`{c}` {kind}" for c, kind in asked.dtypes[1:]) + ", lang_pred string, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for _, texts in groups(batch.column(0)) for x in shared.value.predict(texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=[*kept, "lang_pred", "score"],
            )

    return asked.transform(in_batches, score, schema)


def language_id(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Language of every text: (doc_id, held_out, lang_pred, score)."""
    model = train(docs, max_docs)
    return predictions(docs, model, "doc_id", held_out(F.col("doc_id")).alias("held_out"))


def in_known_language(docs: DataFrame, max_docs: int = MAX_DOCS, least: float = 0.5) -> DataFrame:
    """The rows whose language is recognised with a score of ``least`` or more; all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, max_docs))
    text = docs.columns.index("text")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for _, texts in groups(batch.column(text)) for x in shared.value.predict(texts)]
            keep = [lang != UNKNOWN and score >= least for lang, score in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.transform(in_batches, look, docs.schema)
