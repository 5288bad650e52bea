import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import op12_importance_resampling as op12

from .conftest import odd_rows, prose

ITEMS = "item_id long, text string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(rows, items, percent=10, least=20):
    """(doc_id, n_features, weight, score, rank) of every row, one at a time."""
    def bucket(w):
        return zlib.crc32(w.encode()) % 10_000

    s = Counter(bucket(w) for _, t, *_ in rows for w in words(t))
    t = Counter(bucket(w) for _, x in items for w in words(x))
    all_s, all_t = sum(s.values()) + 10_000.0, sum(t.values()) + 10_000.0
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in s}
    found = []
    for i, x, *_ in rows:
        w = words(x)
        weight, score = sum(gain[bucket(v)] for v in w), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((i, len(w), weight, score))
    able = sorted((-r[3], r[0], k) for k, r in enumerate(found) if r[1] >= least and r[3] is not None)
    rank = {k: n + 1 for n, (_, _, k) in enumerate(able[: percent * len(able) // 100])}
    return [(*r, rank.get(k)) for k, r in enumerate(found)]


def same(got, want):
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def texts(n, seed=1):
    rng = random.Random(seed)
    return [(i, prose(f"{seed}-{i % 37}", rng.choice([3, 19, 20, 21, 60, 200])) + rng.choice(["", " É x-1 Straße", " 漢字"])) for i in range(n)]


@pytest.mark.parametrize("percent", [10, 0, 100, 33])
def test_rows_equal_a_plain_version(spark, docs, percent):
    rows, items = texts(300), [(k, prose(f"b{k}", 30)) for k in range(9)]
    got = op12.importance_resampling(docs(rows), spark.createDataFrame(items, ITEMS), percent)
    same(got, plain(rows, items, percent))


def test_odd_rows(spark, docs):
    rows = [(None if i is None else i - 6, *r) for i, *r in odd_rows(20_000)]  # some ids below 0
    items = [(1, None), (2, ""), (None, prose(2, 300))]
    got = op12.importance_resampling(docs(rows, clashing=True), spark.createDataFrame(items, ITEMS), 50)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    same(got, plain(rows, items, 50))


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    assert op12.importance_resampling(docs([]), none).collect() == []
    rows = texts(40)
    same(op12.importance_resampling(docs(rows), none), plain(rows, []))
    same(op12.importance_resampling(docs([(1, "few words")]), none), plain([(1, "few words")], []))


def test_longer_runs_of_words(spark):
    known = op12.Buckets(97)
    got = op12.buckets_of([b"a", b"b", b"c"], (1, 2), known)
    assert got.tolist() == [zlib.crc32(w) % 97 for w in (b"a", b"b", b"c", b"a b", b"b c")]


def sort(spark, keys, parts, monkeypatch, block=4):
    monkeypatch.setattr(op12, "LEAST_BLOCK", block)
    monkeypatch.setattr(op12, "MOST_BLOCK", block)
    df = spark.createDataFrame([(k, h, low) for k, (h, low) in enumerate(keys)], "row long, high long, low long").repartition(parts)
    rows = df.withColumn("pos", F.monotonically_increasing_id()).persist()
    rows.count()
    bits = [max(int(k[i]) for k in keys).bit_length() for i in (0, 1)]
    placed = op12.radix_positions(rows, len(keys), *bits).collect()
    rows.unpersist()
    return [(r.high, r.low) for r in sorted(placed, key=lambda r: r.pos)], sorted(r.pos for r in placed)


@pytest.mark.parametrize("high, low, parts", [(1 << 30, 1 << 21, 5), (1 << 62, 1 << 62, 3), (3, 1 << 5, 7), (1, 1 << 13, 1), (1 << 13, 1, 2)])
def test_radix_sort_over_many_blocks(spark, monkeypatch, high, low, parts):
    rng = random.Random(high)
    keys = [(rng.randrange(high), rng.randrange(low)) for _ in range(400)]
    got, places = sort(spark, keys, parts, monkeypatch)
    assert got == sorted(keys) and places == list(range(len(keys)))


def test_equal_keys_fill_many_blocks(spark, monkeypatch):
    keys = [(7, 7)] * 300 + [(k % 3, 7) for k in range(100)]
    got, places = sort(spark, keys, 4, monkeypatch)
    assert got == sorted(keys) and places == list(range(len(keys)))


def test_dealing_is_stable():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    pos = rng.permutation(500)
    rows = pa.table({"row": pos, "high": pos, "low": pos, "pos": pos, "block": pos * 0, "digit": (pos % 5).astype("int32")})
    offsets = pa.table({"at": [0] * 5, "code": pa.array(range(5), pa.int32()), "base": [1000 * k for k in range(5)]})
    got = op12._deal(rows, offsets).to_pandas()
    for k in range(5):
        mine = got[got["row"] % 5 == k].sort_values("pos")
        assert mine["pos"].tolist() == list(range(1000 * k, 1000 * k + 100)) and mine["row"].is_monotonic_increasing


def test_drawn_documents_keep_their_columns(spark, docs):
    rows, items = texts(200), [(1, prose("b", 50))]
    df = docs(rows, clashing=True)
    got = op12.resampled(df, spark.createDataFrame(items, ITEMS))
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == {r[0] for r in plain(rows, items) if r[4]}
