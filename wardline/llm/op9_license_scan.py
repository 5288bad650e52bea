"""License notices, exact and misspelt (operator 9).

Texts are reduced to lower-case words with single spaces.  Exact phrases are looked up
there.  For misspelt notices a pattern that may have k edits is split into k + 1 pieces,
one of which must occur unchanged (pigeonhole); an Aho-Corasick automaton finds pieces,
and only around them does the regex library match the notice with bounded edits.

A word is a run of ASCII letters, ASCII digits and non-ASCII characters; A-Z are
lower-cased.  Defined cases: null, empty and word-free texts have no places and no
labels, score 0.  Overlapping places all count.  Rows are scanned as they come, repeated
ones too.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from bisect import bisect, bisect_left
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.words import in_batches
from wardline.sources.readers import strict_csv

# Phrases whose exact places are counted, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Notice(NamedTuple):
    """A short notice that may occur with up to ``edits`` characters changed, left out or put in."""

    label: str
    text: str
    edits: int


NOTICES = (
    Notice("gpl", "gnu general public license", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("apache", "licensed under the apache license", 3),
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 7),
    Notice("cc-by", "licensed under cc by", 2),
    Notice("cc-by", "creative commons attribution", 3),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("unlicense", "released into the public domain", 3),
    Notice("all-rights-reserved", "all rights reserved", 2),
)

OUTPUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans string"
)

_NOT_WORD = bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_TABLE = bytes.maketrans(_NOT_WORD, b" " * len(_NOT_WORD))


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().translate(_TABLE).split()


class Span(NamedTuple):
    """A notice found: words ``first`` to ``last`` (exclusive) and how like the notice they are."""

    label: str
    first: int
    last: int
    likeness: float


def spaces_of(joined: bytes | str) -> list[int]:
    """Places of the spaces in a text, so that words are numbered without counting from its beginning each time."""
    space = b" " if isinstance(joined, bytes) else " "
    found, at = [], joined.find(space)
    while at >= 0:
        found.append(at)
        at = joined.find(space, at + 1)
    return found


def read_notices(spark: SparkSession, path: str) -> tuple[Notice, ...]:
    """Notices from a CSV file with header ``label,text,edits``, their words as texts are normalised.

    The file is a parameter of a scan, held whole by every task.  A notice must be longer than its edits allow to change.
    """
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("text", T.StringType()), T.StructField("edits", T.IntegerType())])
    found = []
    for row in strict_csv(spark, path, schema).collect():
        text = b" ".join(normal_words(row["text"])).decode()
        if not row["label"] or row["edits"] is None or not 0 <= row["edits"] < len(text):
            raise ValueError(f"not a notice: {row}")
        found.append(Notice(row["label"], text, row["edits"]))
    return tuple(found)


class Scanner:
    """The automaton of pieces and the bounded-error patterns of all notices."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES, phrases: dict[str, str] = PHRASES) -> None:
        self.notices = notices
        self.phrases = {f" {p} ".encode(): label for p, label in phrases.items()}

    @cached_property
    def pieces(self) -> ahocorasick.Automaton:
        """Every piece, with the notices that hold it and where."""
        places: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(self.notices):
            n = notice.edits + 1
            cuts = [round(i * len(notice.text) / n) for i in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                places.setdefault(notice.text[a:b], []).append((k, a))
        automaton = ahocorasick.Automaton()
        for piece, held in places.items():
            automaton.add_word(piece, (len(piece), held))
        automaton.make_automaton()
        return automaton

    @cached_property
    def patterns(self) -> list[regex.Pattern]:
        return [regex.compile(f"(?b)(?:{regex.escape(n.text)}){{e<={n.edits}}}") for n in self.notices]

    def base(self, joined: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every exact place; ``joined`` has a space before and after every word."""
        places = []
        for phrase, label in self.phrases.items():
            at = joined.find(phrase)
            while at >= 0:
                places.append((at, label))
                at = joined.find(phrase, at + 1)
        spaces = spaces_of(joined) if places else []
        return [(bisect_left(spaces, at), label) for at, label in places]

    def fuzzy(self, joined: str) -> list[Span]:
        """Notices within their edits: the best match around every piece, without those that overlap a better one."""
        windows: dict[int, set[tuple[int, int]]] = {}
        for end, (length, held) in self.pieces.iter(joined):
            start = end - length + 1
            for k, offset in held:
                notice = self.notices[k]
                lo = max(0, start - offset - notice.edits)
                hi = min(len(joined), start - offset + len(notice.text) + notice.edits)
                windows.setdefault(k, set()).add((lo, hi))
        found, spaces = [], spaces_of(joined) if windows else []
        for k, mine in windows.items():
            notice = self.notices[k]
            matches = set()
            for lo, hi in mine:
                match = self.patterns[k].search(joined, lo, hi)
                inner = match.group().strip() if match else ""
                if inner:
                    start = match.start() + match.group().index(inner)
                    matches.add((sum(match.fuzzy_counts), start, start + len(inner)))
            taken: list[tuple[int, int]] = []  # in order, none overlaps another
            for edits, start, end in sorted(matches):
                at = bisect(taken, (start, end))
                if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
                    continue
                taken.insert(at, (start, end))
                first, last = bisect_left(spaces, start) - 1, bisect_left(spaces, end)
                found.append(Span(notice.label, first, last, 1 - edits / len(notice.text)))
        return found

    def scan(self, text: str | None) -> tuple:
        words = normal_words(text)
        joined = b" " + b" ".join(words) + b" "
        base = self.base(joined)
        spans = self.fuzzy(joined.decode("utf-8")) if words else []
        starts = [at for at, _ in base]
        base_labels = sorted({label for _, label in base})
        labels = sorted({*base_labels, *(s.label for s in spans)})
        score = 1.0 if base else max((s.likeness for s in spans), default=0.0)
        listed = sorted({(s.first, s.last, s.label) for s in spans})
        return (
            len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(base_labels), ",".join(labels), score, ",".join(f"{c}:{a}:{b}" for a, b, c in listed),
        )


def license_scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Exact places, labels, a score and the spans (label:first word:end) of every text."""
    names = [f.split()[0] for f in OUTPUT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.string()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            rows = [scanner.scan(text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0).cast(pa.int64()), *(pa.array([r[k] for r in rows], kinds[k + 1]) for k in range(8))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").transform(in_batches, scan, OUTPUT)
