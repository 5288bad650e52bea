"""Secrets in text, with built-in Spark functions only (operator 8).

Three kinds are found by pattern.  The method adds a fourth: candidate strings (long runs
of the characters that keys are made of) are read by a window of fixed length; symbol
counts are updated as it moves, and with them the window's Shannon entropy.  Windows at
or above the threshold of the string's character class are a span, unless the string is
on the allow-list or a patterned span holds the window already.

Spark finds texts of matches but not their places, so places are summed up from the
lengths of matches and of what lies between them, in blocks, so that a text of very many
matches stays cheap.  Only texts that a pattern occurs in are searched a second time.

Places are code points, ends exclusive.  Defined cases: null and empty texts have no
spans.  Rows are scanned as they come, repeated ones too.  Columns other than ``doc_id``
and ``text`` are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import once

WINDOW = 20
_BLOCK = 256  # matches whose places are summed up together


class Kind(NamedTuple):
    """``pattern`` finds matches from left to right.  Where it has a group, the group's length decides."""

    name: str
    pattern: str
    least: int = 0


ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
)

KINDS = (
    Kind("assign", ASSIGN + r"([A-Za-z0-9+/_.=-]+)", 12),
    Kind("access", "AKIA[A-Z0-9]{14,}"),
    Kind("hex", "[0-9a-f]{16,}"),
)
CANDIDATE = Kind("entropy", f"[A-Za-z0-9+/_=-]{{{WINDOW},}}")


class CharacterClass(NamedTuple):
    """A candidate belongs to the first class whose pattern is all of it."""

    pattern: str
    bits: float


CLASSES = (
    CharacterClass("[0-9a-f]+|[0-9A-F]+", 3.0),
    CharacterClass("[a-z0-9]+|[A-Z0-9]+", 3.6),
    CharacterClass("[A-Za-z0-9+/_=-]+", 3.75),
)

# Strings that look random but are not secrets: words and joined words, numbers, UUIDs.
ALLOWED = (
    "[A-Za-z]+(?:[-_/+=]+[A-Za-z]*)*",
    "[0-9]+(?:[-_/+=]+[0-9]*)*",
    "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _add_matches(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Adds ``name``: array of (start, end, found) of all matches; null if there are none."""
    between, found, sums, bases = (f"{name}_{x}" for x in ("between", "found", "sums", "bases"))
    occurs = F.col(text).rlike(pattern)
    df = df.withColumn(found, F.when(occurs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(between, F.when(F.col(found).isNotNull(), F.split(text, pattern, -1)))
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int"))

    def part(of: str, block: Column) -> Column:
        return F.slice(of, block * _BLOCK + 1, F.lit(_BLOCK))

    lengths = lambda of: F.transform(of, lambda x: F.length(x).cast("long"))
    whole = F.transform(blocks, lambda b: _sum(lengths(part(found, b))) + _sum(lengths(part(between, b))))
    df = df.withColumn(sums, F.when(F.col(found).isNotNull(), whole))
    before = F.transform(sums, lambda x, i: F.when(i == 0, F.lit(0).cast("long")).otherwise(_sum(F.slice(sums, 1, F.greatest(i, F.lit(1))))))
    df = df.withColumn(bases, before)
    empty = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def spans(base: Column, block: Column) -> Column:
        pairs = F.zip_with(
            part(found, block), part(between, block), lambda f, g: F.struct(f.alias("found"), g.alias("gap"))
        )
        pairs = F.filter(pairs, lambda p: p["found"].isNotNull())
        return F.aggregate(pairs, F.struct(base.alias("at"), empty.alias("out")), step)["out"]

    df = df.withColumn(name, F.flatten(F.transform(bases, spans)))
    return df.drop(found, between, sums, bases)


def _plogp(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def _hot_part(string: Column, window: int) -> Column:
    """(first, last) places of the windows of a string that reach its class's entropy; null if none.

    The fold's state holds the count of every ASCII symbol in the window and the sum of
    ``count * log2(count)``; a step adds the symbol that enters and takes the one that leaves.
    """
    bits = reduce(
        lambda rest, c: F.when(string.rlike(f"^(?:{c.pattern})$"), F.lit(c.bits)).otherwise(rest),
        reversed(CLASSES), F.lit(float("inf")),
    )
    codes = F.transform(F.split(string, ""), F.ascii)
    pairs = F.transform(
        F.filter(codes, lambda c: c > 0),
        lambda c, i: F.struct(
            c.alias("enters"),
            F.when(i >= window, F.ascii(F.substr(string, i - window + 1, F.lit(1)))).otherwise(F.lit(-1)).alias("leaves"),
            i.alias("i"),
        ),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("s"), bits.alias("bits"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def step(acc: Column, p: Column) -> Column:
        stays = p["enters"] == p["leaves"]
        more = F.get(acc["counts"], p["enters"])
        less = F.get(acc["counts"], p["leaves"])
        s = F.when(stays, acc["s"]).otherwise(
            acc["s"] + _plogp(more + 1) - _plogp(more)
            + F.when(p["leaves"] >= 0, _plogp(less - 1) - _plogp(less)).otherwise(0.0)
        )
        counts = F.transform(
            acc["counts"], lambda c, k: c + (k == p["enters"]).cast("int") - (k == p["leaves"]).cast("int")
        )
        hot = (p["i"] >= window - 1) & (F.lit(log2(window)) - s / window >= acc["bits"])
        return F.struct(
            counts.alias("counts"), s.alias("s"), acc["bits"].alias("bits"),
            F.coalesce(acc["first"], F.when(hot, p["i"] - window + 1)).alias("first"),
            F.when(hot, p["i"] + 1).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(pairs, start, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def _long_enough(kind: Kind):
    return lambda x: F.length(F.regexp_extract(x["found"], f"^{kind.pattern}$", 1)) >= kind.least


def _outside(spans: str):
    """Whether a span lies within none of the given column."""
    return lambda x: ~F.exists(spans, lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]))


def _with_kind(place: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(place).alias("kind"), x["end"].alias("end"))


def _with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, one array of spans per kind, null where there is none)."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind in (*KINDS, CANDIDATE):
        df = _add_matches(df, "text", kind.pattern, kind.name)
        if kind.least:
            df = df.withColumn(kind.name, F.filter(kind.name, _long_enough(kind)))
    allowed = "^(?:" + "|".join(f"(?:{a})" for a in ALLOWED) + ")$"
    suspects = F.filter(CANDIDATE.name, lambda x: ~x["found"].rlike(allowed))
    df = df.withColumn(CANDIDATE.name, F.when(F.size(suspects) > 0, suspects))
    parts = F.transform(
        CANDIDATE.name, lambda x: F.struct(x["start"].alias("at"), _hot_part(x["found"], WINDOW).alias("part"))
    )
    hot = F.transform(
        F.filter(parts, lambda x: x["part"]["first"].isNotNull()),
        lambda x: F.struct((x["at"] + x["part"]["first"]).alias("start"), (x["at"] + x["part"]["last"]).alias("end")),
    )
    df = df.withColumn(CANDIDATE.name, hot)
    for kind in KINDS:
        outside = F.filter(CANDIDATE.name, _outside(kind.name))
        df = df.withColumn(CANDIDATE.name, F.when(F.col(kind.name).isNull(), F.col(CANDIDATE.name)).otherwise(outside))
    return df.drop("text")


def _listed(names: list[str]) -> Column:
    """``kind:start:end`` of all spans by start, then kind in the order given, comma-joined."""
    tagged = [
        F.coalesce(
            F.transform(n, _with_kind(i)),
            F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"),
        )
        for i, n in enumerate(names)
    ]
    label = lambda x: F.get(F.array(*map(F.lit, names)), x["kind"])
    return F.array_join(F.transform(F.sort_array(F.concat(*tagged)), lambda x: F.concat_ws(":", label(x), x["start"], x["end"])), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """Spans of every text: counts by kind, digest of the patterned spans, and all spans."""
    base = [k.name for k in KINDS]
    count = lambda name: F.coalesce(F.size(name), F.lit(0)).cast("long")
    found = F.struct(
        *(F.greatest(count(n), F.lit(0).cast("long")).alias(f"n_{n}") for n in base),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed([*base, CANDIDATE.name]).alias("spans"),
    )
    return _with_spans(docs).select("doc_id", once(found).alias("found")).select("doc_id", "found.*")
