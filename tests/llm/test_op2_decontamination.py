import random

import duckdb
import numpy as np
import pytest

from wardline.llm import op2_decontamination as op2
from wardline.llm import queries
from wardline.llm.sql import ORACLE_SQL
from wardline.llm.words import words_of

from .conftest import odd_rows, prose

ITEMS = "item_id long, text string"


def shingles(text, n=5):
    words = words_of(text, plain=True)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(rows, items, percent=80):
    sets = [(i, shingles(t)) for i, t in items]
    found = []
    for doc, text in rows:
        mine = shingles(text).union(*(shingles(text, n) for n in range(1, 5)))
        found += [(doc, i, len(s & mine), len(s), len(s & mine) / len(s)) for i, s in sets if s and 100 * len(s & mine) >= percent * len(s)]
    return sorted(found, key=str)


def compare(spark, docs, rows, items, **kw):
    got = op2.contaminated(docs(rows, **kw), spark.createDataFrame(items, ITEMS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain([r[:2] for r in rows], items)


def planted(seed, items, share=1.0, spread=1):
    """A document of prose with ``share`` of each item's words in it, in ``spread`` pieces."""
    parts = [prose(f"{seed}", 300)]
    for i, text in items:
        words = text.split()
        words = words[: round(len(words) * share)]
        size = -(-len(words) // spread)
        for k in range(0, len(words), size):
            parts += [" ".join(words[max(0, k - 4) : k + size]), prose(f"{seed}{i}{k}", 150)]
    return " ".join(parts)


def some_items():
    lengths = [5, 6, 8, 9, 13, 20, 33, 47, 70, 130, 260]
    return [(k, prose(f"item{k}", n, 5000)) for k, n in enumerate(lengths)]


def test_planted_items_are_found(spark, docs):
    items = some_items()
    rows = [(k, planted(k, [items[k % len(items)]])) for k in range(44)]
    rows += [(100 + k, planted(k, [items[k % len(items)]], share=0.9)) for k in range(22)]
    rows += [(200 + k, planted(k, [items[k % len(items)]], share=0.6)) for k in range(22)]
    rows += [(300 + k, planted(k, [items[k]], spread=5)) for k in range(len(items))]
    rows += [(400 + k, prose(f"clean{k}", 400)) for k in range(20)]
    compare(spark, docs, rows, items)
    found = {r[0] for r in plain(rows, items)}
    assert {*range(44), *range(300, 311)} <= found and not found & {*range(400, 420)}


def test_marks_and_case_do_not_hide_an_item(spark, docs):
    text = prose("m", 30, 5000)
    changed = ", ".join(w.upper() for w in text.split())
    compare(spark, docs, [(1, f"before {changed}. after"), (2, "nothing here")], [(9, text)])
    assert plain([(1, f"before {changed}. after")], [(9, text)])


def test_odd_rows_and_items(spark, docs):
    rows = odd_rows(3000)
    items = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "two words"), (5, rows[5][1]), (5, rows[5][1]), (None, rows[9][1][:400])]
    compare(spark, docs, rows, items, clashing=True)


def test_items_shorter_than_a_shingle_are_found_inside_documents(spark, docs):
    """One to four words, equal ones twice, with and without longer items, against brute force and SQL."""
    rng = random.Random(4)
    letters = "abcdefgh"
    rows = [(k, " ".join(rng.choices(letters, k=rng.randrange(0, 40)))) for k in range(60)]
    rows += [(100, "so Red, green; BLUE is it and more words follow here"), (101, "red green"), (102, "red-green-blue"), (None, "red green blue")]
    rows += [(103, prose("long", 40_000) + " red green blue " + prose("more", 40_000)), (104, None), (105, "redgreen blue red")]
    short = [(k, " ".join(rng.choices(letters, k=1 + k % 4))) for k in range(20)]
    short += [(50, "red green blue"), (51, "Red green, blue!"), (52, "a"), (53, "a")]
    long = [(60, "so red green blue is it"), (61, prose("item", 30))]
    for items in (short, short + long, long):
        compare(spark, docs, rows, items, clashing=True)
    assert {r[0] for r in plain(rows, short) if r[1] in (50, 51)} == {100, 102, 103, None}
    df, few = docs(rows), spark.createDataFrame(short[20:22] + long, ITEMS)
    kept = {r.doc_id for r in op2.without_contaminated(df, few).select("doc_id").collect()}
    assert {r[0] for r in rows} - kept == {100}  # short words alone remove nothing unless asked
    asked = {r.doc_id for r in op2.without_contaminated(df, few, short=True).select("doc_id").collect()}
    assert {r[0] for r in rows} - asked == {100, 102, 103, None}


def test_sql_says_the_same_of_short_items():
    con = duckdb.connect()
    items = [(1, "red green blue"), (2, "one"), (3, "so red green blue is it"), (4, None), (5, " ")]
    rows = [(7, "so Red green, BLUE is it and one more"), (8, "red green"), (9, "xred green blue"), (10, None), (11, "none")]
    for name, key, held in (("benchmark", "item_id", items), ("documents", "doc_id", rows)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", held)
    assert sorted(con.execute(ORACLE_SQL["op2_decontamination"]).fetchall()) == plain(rows, items)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert op2.contaminated(docs([]), items).collect() == []
    assert op2.contaminated(docs([(1, "a b c d e f")]), none).collect() == []
    assert op2.without_contaminated(docs([(1, "a")]), none).count() == 1


@pytest.mark.parametrize("bound", [40, 2_000_000])
def test_blocks_of_items(spark, docs, monkeypatch, bound):
    monkeypatch.setattr(op2, "BLOCK_SHINGLES", bound)
    items = some_items()
    rows = [(k, planted(k, items[k : k + 3])) for k in range(len(items))]
    compare(spark, docs, rows, items)
    df = docs([*rows, (99, "clean text of a few words"), (None, None)], clashing=True)
    left = op2.without_contaminated(df, spark.createDataFrame(items, ITEMS))
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["99", "None"]


def test_candidates_across_slices():
    """A block cut by the end of a slice still leads to its item."""
    hashes = op2.word_hashes()
    item = prose("cut", 40, 5000)
    index = op2.build_index([op2.item_of(0, item, hashes, 5)])
    for before in (32_700, 32_740, 32_768, 65_500):
        text = prose("pad", before) + " " + item + " " + prose("post", 100)
        assert [(d, i) for d, i, _ in op2.find_items([None, text], index, hashes, 5, 80)] == [(1, 0)]


def test_query_over_small_tables(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in queries.documents(spark, sf).select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.table(spark, sf, "benchmark").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op2_decontamination(spark, sf).collect()), key=str)
    assert got == plain(rows, items) and got


def test_index_filter_has_no_misses():
    index = op2.build_index([op2.Item(k, np.arange(k, k + 20, dtype=np.uint64)) for k in range(50)])
    for c in index.classes:
        assert c.present[op2._slot(c.cells)].all()
