"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks (operator 11).

A window is a word, a run of fragments of one or two characters ("i d i o t"), or a
stretch of a very long word.  The kernel of two windows counts the subsequences of
``ORDER`` letters they share, each weighted by ``DECAY`` for every place it is stretched,
up to ``SPAN`` places.  Characters that are no letters only widen gaps, so "i.d*i-o t" is
close to "idiot", and a letter too many costs little.  Kernels are divided by the windows'
own lengths in that space.

Learning.  Documents of a bounded sample bring their labels to their sentences and the
windows in them.  Documents that share their least sentence (by hash) are copies or near
copies of one text; such a family counts once, with the label of most of it.  Windows that
are significantly more frequent in toxic families (likelihood ratio, corrected for the
number of windows) are examples of one class, with copies into which characters are put;
windows of clean families are the other: some drawn by hash, then those the first machine
finds most toxic, and the significant ones as often as clean families hold them.  Landmarks are the most significant windows and some drawn ones.  The
eigenvectors of the landmarks' kernel matrix give the Nyström features, and the linear
machine on them (squared hinge loss, Newton's method) is solved on the driver: examples
and landmarks are bounded by the parameters below.  Platt's sigmoid, fitted on the sample's
documents, turns values into scores.

Scoring.  The machine's sum over landmarks is folded into one weight per subsequence,
which gives the same values.  A document's score comes from its ``TOP`` most toxic windows;
every window of the whole text is looked at.  Tasks value each distinct window of a batch once.

Defined cases: null and empty texts, and texts without a letter, have the machine's offset
as their values and get its low score.  Where nothing
could be learned (no labels, none of one class, no significant window) every score is 0.
A document with several label rows is toxic if one says so; labels without a document, and
null labels, teach nothing.  Rows are scored as they come, repeated ones too; a null
``doc_id`` is not held out and teaches nothing.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import groups, in_batches
from wardline.storage import materialize

ORDER = 3  # letters of a subsequence
SPAN = 8  # places it may stretch over
DECAY = 0.7
MAX_DOCS = 2_000  # labelled documents of each class to learn from, drawn by a hash of the id
CHANCE = 1.0  # windows of all that are taken for significant by chance, about
EXAMPLES = 512  # significant windows to learn from
DRAWN = 2_000  # windows of clean families, drawn by hash; again as many found by the first machine
LANDMARKS = 64  # of each kind
COST = 1.0
MOST = 32  # characters of a window
FRAGMENT, FRAGMENTS = 2, 3  # a run has so many pieces of so many characters at least, at most

ALPHABET = 61  # letters that landmarks may use; all others are alike and match nothing
BEGIN, END = "\x02", "\x03"  # the ends of a window, which subsequences may use like letters
TOP = 3  # windows whose values make a document's score
_OTHER = ALPHABET + 3
_BASE = ALPHABET + 4
_KNOWN = 500_000  # windows whose values a task keeps
_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 1 << 10  # where each has a value per landmark

SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes_of(alphabet: str) -> np.ndarray:
    """A number for every code point: 0 for no letter, from 1 on for both ends of a window and the alphabet, ``_OTHER`` for the rest."""
    codes = np.where(_letters(), _OTHER, 0).astype(np.int32)
    for k, letter in enumerate((BEGIN + END + alphabet)[: ALPHABET + 2]):
        codes[ord(letter)] = k + 1
    return codes


def occurrences(strings: list[str], codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Every subsequence of the strings: the string, the subsequence as a number, and its weight."""
    joined = "".join(strings).encode("utf-32-le", "surrogatepass")
    owner = np.repeat(np.arange(len(strings)), [len(s) for s in strings])
    c = codes[np.minimum(np.frombuffer(joined, np.uint32), 0x10FFFF)]
    for b in range(2, SPAN):
        n = len(c) - b
        if n <= 0:
            continue
        at = np.flatnonzero((owner[:n] == owner[b:]) & (c[:n] > 0) & (c[b:] > 0))
        outer = c[at] * (_BASE * _BASE) + c[at + b]
        for a in range(1, b):
            middle = c[at + a]
            whole = middle > 0
            yield owner[at[whole]], outer[whole] + middle[whole] * _BASE, DECAY ** (b + 1 - ORDER)


def evaluate(strings: list[str], codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per string the sum of its subsequences' weights, divided by its length in the kernel's space."""
    found = [np.zeros(0)]
    for lo in range(0, len(strings), _AT_ONCE):
        part = strings[lo : lo + _AT_ONCE]
        value, length = np.zeros(len(part)), np.zeros(len(part))
        for owner, code, decay in occurrences(part, codes):
            value += decay * np.bincount(owner, weights[code], len(part))
            length += decay * decay * np.bincount(owner, minlength=len(part))
        found.append(value / np.sqrt(np.maximum(length, 1e-300)))
    return np.concatenate(found)


def subsequences(string: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A string's place in the kernel's space: its subsequences as numbers, and their weights divided by its length.

    Letters beyond the alphabet match nothing, so subsequences with one only add to the length.
    """
    seen, weights, length = [np.zeros(0, np.int32)], [np.zeros(0)], 0.0
    for _, code, decay in occurrences([string], codes):
        length += decay * decay * len(code)
        known = (code % _BASE != _OTHER) & (code // _BASE % _BASE != _OTHER) & (code // (_BASE * _BASE) != _OTHER)
        seen.append(code[known])
        weights.append(np.full(known.sum(), decay))
    used, place = np.unique(np.concatenate(seen), return_inverse=True)
    return used, np.bincount(place, np.concatenate(weights), len(used)) / math.sqrt(length or 1.0)


def kernel(strings: list[str], landmarks: list[str], codes: np.ndarray) -> np.ndarray:
    """Kernels of strings (rows) with landmarks (columns)."""
    marks = [subsequences(mark, codes) for mark in landmarks]
    used = np.unique(np.concatenate([u for u, _ in marks]))
    place = np.zeros(_BASE**3, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(marks)))
    for k, (u, weights) in enumerate(marks):
        table[place[u], k] = weights
    parts = [np.zeros((0, len(marks)))]
    for lo in range(0, len(strings), _ROWS_AT_ONCE):
        part = strings[lo : lo + _ROWS_AT_ONCE]
        found, length = np.zeros((len(part), len(marks))), np.zeros(len(part))
        for owner, code, decay in occurrences(part, codes):
            length += decay * decay * np.bincount(owner, minlength=len(part))
            at = place[code]
            owner, at = owner[at > 0], at[at > 0]
            if len(owner):
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                found[owner[first]] += decay * np.add.reduceat(table[at], first, axis=0)
        parts.append(found / np.sqrt(np.maximum(length, 1e-300))[:, None])
    return np.concatenate(parts)


def pieces(window: str) -> list[str]:
    """Overlapping stretches of a window longer than ``MOST``."""
    half = MOST // 2
    return [window[k : k + MOST] for k in range(0, max(1, len(window) - half), half)] if len(window) > MOST else [window]


def windows_of(text: str | None) -> list[str]:
    """All windows of a text, in lower case."""
    words = (text or "").lower().split()
    if not words:
        return words
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    short = np.concatenate([[False], lengths <= FRAGMENT, [False]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(short))
    starts, stops = edges[::2], edges[1::2]
    long_enough = stops - starts >= FRAGMENTS
    runs = [" ".join(words[a:b]) for a, b in zip(starts[long_enough].tolist(), stops[long_enough].tolist())]
    if lengths.max() > MOST:
        words = [p for w in words for p in pieces(w)]
    return words + [p for run in runs for p in pieces(run)]


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of a text's sentences."""
    found, at = [], 0
    for end in SENTENCE_END.finditer(text or ""):
        found.append((at, end.start()))
        at = end.end()
    found.append((at, len(text or "")))
    return [(a, b) for a, b in found if a < b]


def widened(window: str) -> list[str]:
    """Copies of a window with a character put in."""
    extra = ".-*x "
    one = [window[:i] + extra[i % len(extra)] + window[i:] for i in range(1, len(window))]
    return [*one, ".".join(window), " ".join(window)]


@dataclass(frozen=True)
class Model:
    """One weight per subsequence, the offset, and the sigmoid's numbers."""

    codes: np.ndarray
    weights: np.ndarray
    offset: float
    sigmoid: tuple[float, ...] = (1.0,) + (0.0,) * TOP

    def values(self, windows: list[str]) -> np.ndarray:
        return evaluate([marked(w) for w in windows], self.codes, self.weights) + self.offset

    def chances(self, values: np.ndarray) -> np.ndarray:
        """Scores from rows of the greatest values."""
        return 1 / (1 + np.exp(-np.clip(values @ np.array(self.sigmoid[:-1]) + self.sigmoid[-1], -500, 500)))


class Known(dict):
    """Values of the windows met before, up to a fixed number."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def greatest(self, found: list[list[str]]) -> np.ndarray:
        """The ``TOP`` greatest values of different windows of each list (a row), from the greatest on; the offset where there are fewer."""
        distinct = [set(f) for f in found]
        new = set().union(*distinct).difference(self)
        if len(self) + len(new) > _KNOWN:
            self.clear()
            new = set().union(*distinct)
        new = list(new)
        self.update(zip(new, self.model.values(new).tolist()))
        rows = np.full((len(found), TOP), self.model.offset)
        for row, held in zip(rows, distinct):
            most = heapq.nlargest(TOP, map(self.__getitem__, held))
            row[: len(most)] = most
        return rows


def solve(features: np.ndarray, signs: np.ndarray, weights: np.ndarray, cost: float) -> np.ndarray:
    """The linear machine of least squared hinge loss; the last number is its offset."""
    x = np.hstack([features, np.ones((len(features), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    inside = np.ones(len(x), bool)
    for _ in range(50):
        held = x[inside] * (2 * cost * weights[inside])[:, None]
        w = np.linalg.solve(ridge + held.T @ x[inside], held.T @ signs[inside])
        now = signs * (x @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w


def machine(positive: dict[str, int], negative: dict[str, int], landmarks: list[str], codes: np.ndarray, cost: float = COST) -> Model:
    """The machine on Nyström features of the examples, folded into weights of subsequences.

    Examples weigh as much as the families that hold them; all copies of one as much as itself.
    """
    strings, weights, signs = [], [], []
    for examples, sign in ((positive, 1.0), (negative, -1.0)):
        for window, count in examples.items():
            copies = widened(window) if sign > 0 else [".".join(window)]
            strings += [window, *copies]
            weights += [float(count), *[count / len(copies)] * len(copies)]
            signs += [sign] * (1 + len(copies))
    weights, signs = np.array(weights), np.array(signs)
    marks = [marked(mark) for mark in landmarks]
    own, vectors = np.linalg.eigh(kernel(marks, marks, codes))
    used = own > 1e-8 * own[-1]
    to_features = vectors[:, used] / np.sqrt(own[used])
    w = solve(kernel([marked(s) for s in strings], marks, codes) @ to_features, signs, weights, cost)
    alphas = to_features @ w[:-1]
    folded = np.zeros(_BASE**3)
    for alpha, mark in zip(alphas, marks):
        used, place = subsequences(mark, codes)
        folded[used] += alpha * place
    return Model(codes, folded, float(w[-1]))


def platt(values: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """The sigmoid over rows of values, its shift last, by Newton's method on smoothed targets."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([values, np.ones(len(values))])
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(len(w))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (target - p) - ridge @ w)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from: ``crc32`` of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(text, toxic) of about ``max_docs`` documents of each class at most, none of them held out."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    each = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = each.groupBy("toxic").agg(F.count("*").alias("n"))  # one row per class
    spread = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    drawn = each.join(F.broadcast(counts), "toxic").filter(spread < F.lit(float(max_docs)) / F.col("n")).select("doc_id", "toxic")
    ids = materialize(drawn, "labelled")  # at most about 2 * max_docs rows
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(ids), "doc_id").select("text", "toxic")


def families(sampled: DataFrame) -> DataFrame:
    """(family, toxic, windows) of every document: the least hash of its sentences, its label, its windows of three letters and more."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, windows = [], []
            for text in batch.column(0):
                text = text.as_py()
                held = {text[a:b].lower() for a, b in sentences(text)} or {""}
                least.append(min(xxhash.xxh3_64_intdigest(h.encode("utf-8", "replace")) >> 1 for h in held))
                found = {trimmed(w) for h in held for w in windows_of(h)}
                windows.append([w for w in found if sum(map(str.isalpha, w)) >= ORDER])
            yield pa.RecordBatch.from_arrays(
                [pa.array(least, pa.int64()), batch.column(1), pa.array(windows, pa.list_(pa.string()))], names=["family", "toxic", "windows"]
            )

    return sampled.transform(in_batches, split, "family long, toxic int, windows array<string>")


def window_counts(found: DataFrame) -> DataFrame:
    """(window, toxic, clean): how many families of either class hold a window; the null window counts all families."""
    label = found.groupBy("family").agg((F.avg("toxic") >= 0.5).cast("long").alias("toxic"))
    held = found.select("family", F.explode(F.concat("windows", F.array(F.lit(None).cast("string")))).alias("window")).distinct()
    counted = held.join(label, "family").groupBy("window").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    return counted.select("window", "toxic", (F.col("n") - F.col("toxic")).alias("clean"))


def trimmed(window: str) -> str:
    """A window from its first to its last letter."""
    at = [i for i, c in enumerate(window) if c.isalpha()]
    return window[at[0] : at[-1] + 1] if at else ""


def marked(window: str) -> str:
    """A window as the kernel sees it: from its first to its last letter, with both ends."""
    return f"{BEGIN}{trimmed(window)}{END}"


def _likelihood_ratio(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """How much better two rates explain a window's counts than one."""
    total = all_toxic + all_clean

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    with_ = toxic + clean
    return 2 * (
        part(toxic, with_ * all_toxic / total) + part(clean, with_ * all_clean / total)
        + part(all_toxic - toxic, (total - with_) * all_toxic / total) + part(all_clean - clean, (total - with_) * all_clean / total)
    )


def _most_toxic(clean: DataFrame, model: Model, most: int) -> dict[str, int]:
    """The windows of clean families that a machine finds most toxic."""
    shared = clean.sparkSession.sparkContext.broadcast(model)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.values(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["window", "clean", "value"])

    valued = clean.select("window", "clean").transform(in_batches, value, "window string, clean long, value double")
    return {r["window"]: r["clean"] for r in valued.orderBy(F.desc("value"), "window").limit(most).collect()}


def _codes(landmarks: list[str]) -> np.ndarray:
    """The numbering of letters by how often landmarks use them."""
    used = Counter(c for mark in landmarks for c in mark if c.isalpha())
    return codes_of("".join(c for c, _ in sorted(used.items(), key=lambda x: (-x[1], x[0]))))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model | None:
    """Fit on the texts and ``toxic`` labels of documents that are not held out; None if they teach nothing."""
    sampled = materialize(sample(docs, labels, max_docs), "sample")
    counts = materialize(window_counts(materialize(families(sampled), "families")), "windows")
    whole = counts.filter(F.col("window").isNull()).first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return None
    n1, n0 = whole["toxic"], whole["clean"]
    several = F.count(F.when(F.col("toxic") + F.col("clean") > 1, 1))
    many = counts.agg(several).first()[0]
    ratio = _likelihood_ratio(F.col("toxic"), F.col("clean"), n1, n0)
    named = counts.filter(F.col("window").isNotNull())
    more = named.filter(F.col("toxic") * n0 > F.col("clean") * n1).withColumn("ratio", ratio)
    enough = 2 * math.log(max(many, 2) / CHANCE)
    significant = more.filter(F.col("ratio") >= enough).orderBy(F.desc("ratio"), "window").limit(EXAMPLES).collect()
    if not significant:
        return None
    positive = {r["window"]: r["toxic"] for r in significant}
    both = {r["window"]: r["clean"] for r in significant if r["clean"]}
    clean = named.join(F.broadcast(named.sparkSession.createDataFrame([(w,) for w in positive], "window string")), "window", "left_anti").filter("clean > 0")
    drawn = {r["window"]: r["clean"] for r in clean.orderBy(F.xxhash64("window"), "window").limit(DRAWN).collect()}
    landmarks = [*list(positive)[:LANDMARKS], *list(drawn)[:LANDMARKS]]
    first = machine(positive, both | drawn, landmarks, _codes(landmarks))
    near = _most_toxic(clean, first, DRAWN)
    landmarks += [w for w in list(near)[:LANDMARKS] if w not in landmarks]
    codes = _codes(landmarks)
    model = machine(positive, both | drawn | near, landmarks, codes)
    rows = _valued(sampled, model, "toxic").collect()  # at most about 2 * max_docs rows
    values, toxic = np.array([r["top"] for r in rows]), np.array([r["toxic"] > 0 for r in rows])
    return Model(codes, model.weights, model.offset, platt(values, toxic))


def _valued(docs: DataFrame, model: Model, *columns: Column | str) -> DataFrame:
    """The given columns of every row with its greatest values, as ``top``, and its ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    asked = docs.select(F.col("text"), *columns)
    kept = asked.columns[1:]
    schema = ", ".join(f"`{c}` {kind}" for c, kind in asked.dtypes[1:]) + ", top array<double>, score double"

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            found = [known.greatest([windows_of(t) for t in texts]) for _, texts in groups(batch.column(0))]
            top = np.concatenate([np.zeros((0, TOP)), *found])
            columns = [pa.array(list(top), pa.list_(pa.float64())), pa.array(shared.value.chances(top))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*kept, "top", "score"])

    return asked.transform(in_batches, value, schema)


def toxicity(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Toxicity of every text: (doc_id, held_out, score, predicted)."""
    model = train(docs, labels, max_docs)
    columns = "doc_id", held_out(F.col("doc_id")).alias("held_out")
    if model is None:
        scored = docs.select(*columns, F.lit(0.0).alias("score"))
    else:
        scored = _valued(docs, model, *columns).drop("top")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxic_sentences(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Sentences with a score of ``least`` or more: (doc_id, start, end, sentence, score), places in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "start", "end", "sentence", "score"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                spans = sentences(text)
                values = known.greatest([windows_of(text[a:b]) for a, b in spans])
                rows += [(doc_id, a, b, text[a:b], p) for (a, b), p in zip(spans, shared.value.chances(values).tolist()) if p >= least]
            columns = list(zip(*rows)) or [[]] * len(names)
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    id_type = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").transform(in_batches, find, f"doc_id {id_type}, start long, end long, sentence string, score double")
