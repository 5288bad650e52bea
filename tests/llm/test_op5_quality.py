import re
from collections import Counter

import duckdb
import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from wardline.llm import op5_quality_rules as op5
from wardline.llm import queries

from .conftest import odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    base = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), base)


def measured(docs, texts, **kw):
    got = op5.quality_rules(docs(list(enumerate(texts)), **kw)).orderBy("doc_id").collect()
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], got


def test_odd_rows(docs):
    texts = [r[1] for r in odd_rows()]
    assert measured(docs, texts, clashing=True)[0] == [plain(t) for t in texts]


def test_repeats_that_overlap_touch_and_cross(docs):
    a, b = "a b c d e", "f g h i j"
    texts = [
        " ".join(["x"] * n) for n in (4, 5, 6, 7, 11)
    ] + [f"{a} {a}", f"{a} {b} {a}", f"{a} q {b} z {a} {b}", f"{a} f {a} f g", "p " * 3 + prose(1, 50) + " " + prose(1, 50), "a b c d e f a b c d e f g"]
    assert measured(docs, texts)[0] == [plain(t) for t in texts]


def test_random_texts(docs):
    @given(st.lists(st.lists(st.sampled_from(["a", "b", "é", "#x", "<>", "\U0001f600", " ", "\n", "\n\n", "\t", "\x0b", " "]), max_size=60), min_size=1, max_size=40))
    @settings(max_examples=6, deadline=None, phases=[Phase.generate])
    def check(parts):
        texts = [" ".join(p) for p in parts] + ["".join(p) for p in parts]
        assert measured(docs, texts)[0] == [plain(t) for t in texts]

    check()


@pytest.mark.parametrize(
    ("text", "rule"),
    [
        (prose(1, 5), "n_words"),
        ("the of and " + " ".join("#%$" + w for w in prose(1, 40).split()), "symbol_ratio"),
        (prose(1, 60), "stop_word_ratio"),
        ("\n".join(["the same line of words in here"] * 3 + ["and other"]), "repeat_word_ratio"),
        ("the of and to " * 1 + " ".join("w" * 30 + str(k) for k in range(30)), "mean_word_chars"),
    ],
)
def test_each_rule_breaks(docs, text, rule):
    (row,) = measured(docs, [text])[1]
    assert rule in row.failed_rules.split(",") and not row.kept


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    labels = queries.table(spark, sf, "labels").filter("quality = 1")
    good = queries.op5_quality_rules(spark, sf).join(labels, "doc_id").filter("n_words >= 20")
    kept, every = good.filter("kept").count(), good.count()
    assert every > 3000 and kept / every > 0.97


def test_agrees_with_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
        want = con.execute(op5.ORACLE_SQL)
        names = [d[0] for d in want.description]
        got = queries.op5_quality_rules(spark, f"/root/testdata/{sf}")
        assert got.columns == names
        assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


def test_empty_table_and_no_python(docs):
    df = op5.quality_rules(docs([]))
    assert df.collect() == []
    assert "Python" not in df._jdf.queryExecution().toString()
