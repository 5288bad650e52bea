import numpy as np
import pytest

from wardline.llm import op3_minhash_dedup as op3
from wardline.llm import queries
from wardline.llm.words import CirculantMinHash, bands, splitmix

from .conftest import odd_rows, prose


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(rows, n, percent):
    """Sizes and components from comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    found = [(i, len(s), root(i), root(i) == i) for i, s in sets]
    return sorted(found + [(None, len(shingles(t, n)), None, True) for i, t in rows if i is None], key=str)


def compare(docs, rows, n=3, percent=85, **kw):
    got = op3.near_duplicates(docs(rows, **kw), n, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain([r[:2] for r in rows], n, percent)


def edited(text, seed, changes):
    words = text.split()
    rng = np.random.default_rng(seed)
    for at in rng.choice(len(words), changes, replace=False):
        words[at] = f"new{seed}x{at}"
    return " ".join(words)


def test_permutations_are_bijections():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65_537)
    for k in (0, 1, 77):
        assert len(np.unique(CirculantMinHash.second(x, k))) == len(x)
    assert len(np.unique(splitmix(np.arange(10_000, dtype=np.uint64)))) == 10_000


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 900).astype(np.uint64)
    a, b = pool[:600], pool[300:]  # similarity 1/3
    minhash = CirculantMinHash(2000)
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, 600]))
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.06
    assert minhash.SLICE > 1000
    minhash.SLICE = 128  # runs that cross slices
    assert (minhash.signatures(np.concatenate([a, b]), np.array([0, 600])) == s).all()


def test_enough_bands():
    for t in (0.8, 0.85, 0.95):
        assert (1 - t**5) ** bands(t) <= 1e-6


def test_odd_rows(docs):
    compare(docs, odd_rows(2000), clashing=True)


def test_empty_table(docs):
    assert op3.near_duplicates(docs([])).collect() == []
    assert op3.without_near_duplicates(docs([])).collect() == []


def test_near_copies_and_chains(docs):
    rows, n = [], 0
    for base in range(12):
        text = prose(base, 120)
        rows.append((n, text))
        n += 1
        for k in range(6):
            text = edited(text, 100 * base + k, 1 + k % 4)  # each close to the one before
            rows.append((n, text))
            n += 1
    compare(docs, rows)
    compare(docs, rows, 5, 80)


@pytest.mark.parametrize("small", [2, 32])
def test_large_buckets_without_all_pairs(docs, monkeypatch, small):
    """A shared passage brings many texts to one bucket; links among them are still all found."""
    monkeypatch.setattr(op3, "SMALL_BUCKET", small)
    passage = prose("shared", 90)
    rows = [(k, passage + " " + prose(k, 60)) for k in range(60)]
    rows += [(100 + k, edited(rows[k][1], k, 2)) for k in range(20)]
    rows += [(200 + k, edited(passage, k, 3)) for k in range(25)]
    compare(docs, rows)


def test_long_chain_of_components(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(101, 100), (102, 101), (103, 100)], "u long, v long")
    got = dict(map(tuple, op3.components(links).collect()))
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100, 102: 100, 103: 100}


def test_early_shingles_lead_to_every_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**40, 60).tolist()
    sets = []
    for k in range(60):
        own = rng.integers(0, 2**40, 9).tolist()
        sets.append((k, sorted({*base[: 45 + k % 16], *own[: k % 10]})))
    df = spark.createDataFrame([(k, len(s), s) for k, s in sets], "rep long, n_shingles long, shingles array<long>")
    for percent in (70, 85, 100):
        got = {tuple(r) for r in op3._by_rare_shingles(df.selectExpr("rep", "rep AS label"), df, percent).collect()}
        for a, x in sets:
            for b, y in sets:
                if a < b and 100 * len({*x} & {*y}) >= percent * len({*x} | {*y}):
                    assert (b, a) in got


def test_members_of_one_label_never_meet(spark):
    """Joins after the first carry both labels in their keys, so a finished group costs what others ask of it."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**40, 50).tolist()
    sets = [(k, sorted({*base, *rng.integers(0, 2**40, 1).tolist()})) for k in range(80)]
    df = spark.createDataFrame([(k, len(s), s) for k, s in sets], "rep long, n_shingles long, shingles array<long>")
    found = op3._by_rare_shingles(df.selectExpr("rep", "IF(rep < 70, 0, rep) AS label"), df, 85)
    assert {tuple(r) for r in found.collect()} == {(b, a) for b in range(70, 80) for a in range(b)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert len(joins) == 3 and sum("la#" in j or "label#" in j for j in joins) == 3


def test_one_of_each_group_stays(docs):
    text = prose(1, 60)
    rows = [(3, text), (1, text), (2, prose(2, 60)), (2, prose(2, 60)), (None, text), (4, None)]
    df = docs(rows, clashing=True)
    kept = op3.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 4]


def test_query_over_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.documents(spark, sf).select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op3_minhash_dedup(spark, sf).collect()), key=str)
    assert got == plain(rows, 3, 85)
