"""Mixing sources to target weights as a min-cost flow (operator 10).

1. Documents are added up by membership pattern (the set of sources that hold them).
2. Sources get targets: shares of all words by weight, none above ``MOST_COPIES`` times
   its own words, the excess shared again by weight.
3. A flow sends words from patterns to sources.  A pattern offers its words once for
   nothing and again for a rising price, so repetition is spread as thinly as targets
   allow.  Patterns and sources, never documents, reach the driver.
4. Each pattern's flow becomes whole documents: full rounds of every document, and for
   the rest the documents that come first in a seeded order.  Where the order is cut is
   found from sums over ranges of the seeded hash, range within range, so no source is
   ever sorted in one task.  Past a document larger than the words left, the order goes on with
   those no larger, until none fits.  If words are still left, the smallest document not
   taken is, and others are given back for it in the same way, if that comes closer.
   Where a pattern serves several sources, they take turns along the same order.

Defined cases: null and blank texts have size 0 and are never taken.  A null source is a
source of its own, last in order.  Repeated rows count as documents of their own and are
taken alike.  An empty table gives no rows.  Reruns choose the same documents: the order
is a hash of seed, ``doc_id`` and text.  Other columns are ignored.
"""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.storage import materialize

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BITS, LEVELS = 10, 6  # the seeded hash is cut to 2^BITS ranges, and each of these again
LAST = (1 << 63) - 1  # of the seeded order

Source = str | None
Pattern = str  # a document's sources as a JSON list, in order


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null counts none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(
    sizes: dict[Source, int], weights: dict[Source, int], total: float, most: float = MOST_COPIES
) -> dict[Source, float]:
    """Words wanted of each source: shares of ``total`` by weight, ``most`` times its size at most."""
    left, open_ = total, list(sizes)
    found: dict[Source, float] = {}
    while open_:
        weight = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / weight > most * sizes[s]]
        if not over:
            return found | {s: left * weights[s] / weight for s in open_}
        for s in over:
            found[s] = float(most * sizes[s])
        left -= sum(found[s] for s in over)
        open_ = [s for s in open_ if s not in found]
    return found


def route(
    patterns: dict[tuple[Source, ...], int], wanted: dict[Source, float], most: int = MOST_COPIES
) -> dict[tuple[Source, ...], dict[Source, float]]:
    """Words each pattern gives to each of its sources at least cost.

    Copy k of a pattern's words costs k - 1, so cost is convex in repetition.  Patterns that
    share no source, directly or through others, are flows of their own.
    """
    above: dict[Source, Source] = {}

    def top(s: Source) -> Source:
        while above.setdefault(s, s) != s:
            above[s] = above[above[s]]
            s = above[s]
        return s

    for p in patterns:
        for s in p[1:]:
            above[top(s)] = top(p[0])
    networks = defaultdict(list)
    for p in patterns:
        networks[top(p[0])].append(p)
    found = {}
    for connected in networks.values():
        found |= _cheapest_flow({p: patterns[p] for p in connected}, wanted, most)
    return found


def _cheapest_flow(
    patterns: dict[tuple[Source, ...], int], wanted: dict[Source, float], most: int
) -> dict[tuple[Source, ...], dict[Source, float]]:
    """Successive shortest paths over a graph of patterns and sources."""
    sources = sorted({s for p in patterns for s in p}, key=lambda s: (s is None, s))
    at = {("p", p): 1 + i for i, p in enumerate(patterns)}
    at |= {("s", s): 1 + len(patterns) + i for i, s in enumerate(sources)}
    end = 1 + len(at)
    graph: list[list[list]] = [[] for _ in range(end + 1)]

    def join(a: int, b: int, room: float, cost: int) -> None:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0.0, -cost, len(graph[a]) - 1])

    for p in patterns:
        for copy in range(most):
            join(0, at["p", p], float(patterns[p]), copy)
        for s in p:
            join(at["p", p], at["s", s], float("inf"), 0)
    for s in sources:
        join(at["s", s], end, wanted[s], 0)
    while True:
        cost, via = {0: 0}, {}
        queue = [0]
        for node in queue:  # Bellman-Ford with a queue: costs are small whole numbers
            for i, (b, room, c, _) in enumerate(graph[node]):
                if room > 1e-6 and cost[node] + c < cost.get(b, 1 << 30):
                    cost[b], via[b] = cost[node] + c, (node, i)
                    queue.append(b)
        if end not in via:
            break
        path, node = [], end
        while node:
            path.append(via[node])
            node = via[node][0]
        amount = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            b, _, _, back = graph[a][i]
            graph[a][i][1] -= amount
            graph[b][back][1] += amount
    place = {node: s for (kind, s), node in at.items() if kind == "s"}
    return {p: {place[b]: graph[b][back][1] for b, _, _, back in graph[at["p", p]] if b in place} for p in patterns}


class Point(NamedTuple):
    """A place along a pattern's order: ``rounds`` of every document, then those below ``bound``."""

    rounds: int = 0
    bound: int = 0


@dataclass
class Turn:
    """What one source takes of one pattern: the copies between two points, and some one by one."""

    pattern: Pattern
    source: Source
    start: Point = Point()
    end: Point = Point()
    left: float = 0.0
    further: list[tuple[int, int, int]] = field(default_factory=list)  # stretches of the order, with the largest size taken there
    fits: list[int] = field(default_factory=list)
    back: list[tuple[int, int, int]] = field(default_factory=list)  # like ``further``, taken once less


def measured(docs: DataFrame, sources: Column, seed: int, *columns: Column | str) -> DataFrame:
    """The given columns with each document's pattern, size and place in the seeded order."""
    pattern = F.to_json(F.array_sort(F.array_distinct(sources)))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 1)
    return docs.select(*columns, pattern.alias("pattern"), word_count(F.col("text")).alias("size"), order.alias("order"))


def _along(sized: DataFrame, asked: dict[tuple[Pattern, int], tuple[float, int, int, int]]) -> dict[tuple[Pattern, int], tuple[int, float, int]]:
    """Where words end along a pattern's order, how many are left, and the largest document that stopped them.

    ``asked``: the words, where to begin and to end, and the largest size that counts.
    """
    found = {}
    open_ = {key: (words, 0, *limits) for key, (words, *limits) in asked.items()}
    for level in range(LEVELS):
        if not open_:
            break
        rows = [(*key, *limits) for key, (_, *limits) in open_.items()]
        places = sized.sparkSession.createDataFrame(rows, "pattern string, i int, prefix long, begin long, until long, most long")
        prefix = F.shiftrightunsigned("order", 63 - BITS * level) if level else F.lit(0).cast("long")
        inside = F.shiftrightunsigned("order", 63 - BITS * (level + 1)).bitwiseAND((1 << BITS) - 1)
        sums = (
            sized.withColumns({"prefix": prefix, "range": inside})
            .join(F.broadcast(places), ["pattern", "prefix"])
            .filter("size > 0 and size <= most and order >= begin and order < until")
            .groupBy("pattern", "i", "range").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("size").alias("largest"))
        )
        held: dict[tuple[Pattern, int], dict[int, tuple[int, int, int]]] = defaultdict(dict)
        for row in sums.collect():  # at most 2^BITS rows a pattern
            held[row["pattern"], row["i"]][row["range"]] = row["size"], row["n"], row["largest"]
        still = {}
        for key, (left, before, *limits) in open_.items():
            at = 0
            while at < 1 << BITS and held[key].get(at, (0, 0, 0))[0] <= left:
                left -= held[key].get(at, (0, 0, 0))[0]
                at += 1
            bound = (before << BITS) + at
            _, n, largest = held[key].get(at, (0, 0, 0))
            found[key] = min(bound << (63 - BITS * (level + 1)), LAST), left, largest
            if n > 1 and left >= 1:
                still[key] = left, bound, *limits
        open_ = still
    return found


def _points(sized: DataFrame, asked: dict[Pattern, list[float]], sizes: dict[Pattern, int]) -> dict[tuple[Pattern, int], tuple[Point, float]]:
    """Where ``asked`` words of each pattern's order end, and how many of them are left there."""
    found, open_ = {}, {}
    for p, amounts in asked.items():
        for i, words in enumerate(amounts):
            rounds = int(min((words + 1e-6) // sizes[p], MOST_COPIES)) if sizes[p] else 0
            left = max(0.0, words - rounds * sizes[p]) if rounds < MOST_COPIES else 0.0
            found[p, i] = Point(rounds), left
            if sizes[p] and left >= 1:
                open_[p, i] = left, 0, LAST, LAST
    for key, (bound, left, _) in _along(sized, open_).items():
        found[key] = Point(found[key][0].rounds, bound), left
    return found


Stretch = tuple[int, int, int]  # of the order: begin, end, and the largest size that counts


def _go_on(
    sized: DataFrame, asked: dict[tuple[Pattern, int], tuple[float, int, int]]
) -> dict[tuple[Pattern, int], tuple[list[Stretch], float]]:
    """Stretches whose documents make up the words asked between two places, until none fits, and the words left.

    Rows of the same order (repeated ones) are taken together; where they are too large
    together, the order goes on with smaller documents.
    """
    found: dict[tuple[Pattern, int], tuple[list[Stretch], float]] = {key: ([], words) for key, (words, *_) in asked.items()}
    open_ = {key: (words, begin, until, int(words)) for key, (words, begin, until) in asked.items() if words >= 1}
    while open_:
        still = {}
        for key, (bound, left, largest) in _along(sized, open_).items():
            before, begin, until, most = open_[key]
            taken = left < before
            bound = min(max(begin, bound), until)
            if taken:
                found[key] = [*found[key][0], (begin, bound, most)], left
            most = min(int(left), most if taken else largest - 1)
            if largest and most >= 1:
                still[key] = left, bound, until, most
        open_ = still
    return found


def _within(stretches: str, order: Column, size: Column) -> Column:
    """Whether a document lies in one of the stretches."""
    return F.exists(stretches, lambda s: (order >= s["begin"]) & (order < s["end"]) & (size <= s["most"]))


_STRETCHES = "array<struct<begin: long, end: long, most: long>>"


def _fit(sized: DataFrame, turns: list[Turn]) -> None:
    """Give the words each turn has left to the smallest document not taken, and others back, if that comes closer."""
    rows = [(t.pattern, k, t.end.bound, t.left, t.further) for k, t in enumerate(turns) if t.left >= 1]
    if not rows:
        return
    open_ = sized.sparkSession.createDataFrame(rows, f"pattern string, k int, bound long, left double, further {_STRETCHES}")
    free = (F.col("size") > 0) & (F.col("order") >= F.col("bound")) & ~_within("further", F.col("order"), F.col("size"))
    rest = sized.join(F.broadcast(open_), "pattern").filter(free)
    best = rest.groupBy("k").agg(F.min(F.struct("size", "order")).alias("best")).select("k", "best.*").collect()
    chosen = {(turns[row["k"]].pattern, row["k"]): row for row in best}
    over = {}
    for (p, k), row in chosen.items():
        t = turns[k]  # documents that earlier turns share are not given back
        over[p, k] = row["size"] - t.left, 0, t.end.bound if t.start == Point() else 0
    for (p, k), (back, beyond) in _go_on(sized, over).items():
        t = turns[k]
        if abs(beyond) < t.left:
            t.fits, t.back, t.left = [chosen[p, k]["order"]], back, -beyond


@dataclass(frozen=True)
class Mix:
    """Sizes and targets of sources, and what each takes of each pattern."""

    sizes: dict[Source, int]
    targets: dict[Source, float]
    turns: list[Turn]

    def table(self, spark) -> DataFrame:
        """One row per pattern and source that takes from it."""
        rows = [
            (t.pattern, t.source, self.sizes[t.source], self.targets[t.source], *t.start, *t.end, t.further, t.fits, t.back)
            for t in self.turns
        ]
        return spark.createDataFrame(
            rows,
            "pattern string, mix_source string, source_size long, target double, "
            f"start_rounds int, start_bound long, end_rounds int, end_bound long, "
            f"further {_STRETCHES}, fits array<long>, back {_STRETCHES}",
        )


def in_order(sources) -> list[Source]:
    """Sources by code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> Mix:
    """Targets and cuts for documents measured as (pattern, size, order)."""
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("size")).collect()
    sizes = {r["pattern"]: r["size"] for r in rows}
    members = {p: tuple(in_order(json.loads(p))) for p in sizes}
    by_source: dict[Source, int] = defaultdict(int)
    for p, n in sizes.items():
        for s in members[p]:
            by_source[s] += n
    order = in_order(by_source)
    share = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    wanted = targets(dict(by_source), share, total=float(sum(sizes.values())))
    flows = route({members[p]: n for p, n in sizes.items()}, wanted)
    ends: dict[Pattern, list[float]] = {}
    for p in sizes:
        total, ends[p] = 0.0, []
        for s in members[p]:
            total += flows[members[p]].get(s, 0.0)
            ends[p].append(total)
    points = _points(sized, ends, sizes)
    turns = []
    for p in sizes:
        start = Point()
        for i, s in enumerate(members[p]):
            end, left = points[p, i]
            last = i == len(members[p]) - 1 and end.rounds < MOST_COPIES
            turns.append(Turn(p, s, start, end, left if last else 0.0))
            start = end
    behind = {(t.pattern, k): (t.left, t.end.bound, LAST) for k, t in enumerate(turns)}
    for (_, k), (further, left) in _go_on(sized, behind).items():
        turns[k].further, turns[k].left = further, left
    _fit(sized, turns)
    return Mix(dict(by_source), wanted, turns)


def with_copies(measured_docs: DataFrame, mix: Mix) -> DataFrame:
    """Measured documents once per source they serve, with the copies that source takes."""
    def upto(end: str) -> Column:
        return F.col(f"{end}_rounds") + (F.col("order") < F.col(f"{end}_bound")).cast("int")

    order, size = F.col("order"), F.col("size")
    behind = _within("further", order, size) | F.array_contains("fits", order)
    taken = upto("end") - upto("start") + behind.cast("int") - _within("back", order, size).cast("int")
    table = F.broadcast(mix.table(measured_docs.sparkSession))
    return measured_docs.join(table, "pattern").withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(0))


def _sized(docs: DataFrame, sources: Column, seed: int) -> DataFrame:
    """Pattern, size and order of every row, written: several passes read them."""
    return materialize(measured(docs, sources, seed, "doc_id"), "sizes")


def source_mix(
    docs: DataFrame, sources: Column | None = None, weights: tuple[int, ...] = WEIGHTS, seed: int = 1
) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken), one row per row and source that holds it.

    ``sources`` is an array of the sources a document belongs to; the ``source`` column alone by default.
    """
    sized = _sized(docs, F.array("source") if sources is None else sources, seed)
    chosen = with_copies(sized, plan_mix(sized, weights))
    return chosen.select(
        "doc_id", "size", F.col("mix_source").alias("source"), "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame, sources: Column | None = None, weights: tuple[int, ...] = WEIGHTS, seed: int = 1
) -> DataFrame:
    """The rows the mix takes, each as often as it is taken; all columns as they were."""
    sources = F.array("source") if sources is None else sources
    mix = plan_mix(_sized(docs, sources, seed), weights)
    whole = measured(docs, sources, seed, F.struct(*docs.columns).alias("row"))
    taken = with_copies(whole, mix).filter("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
