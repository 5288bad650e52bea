import random
import re

from wardline.llm import op7_substring_dedup as op7
from wardline.llm import queries

from .conftest import odd_rows, prose


def planted(n_passages=20, copies=4, words=52):
    """Clean prose, and documents that share passages of ``words`` words."""
    rows, shared, n = [], {}, 0
    for k in range(n_passages):
        passage = prose(f"p{k}", words, 3000)
        for c in range(copies):
            text = prose(f"a{k}{c}", random.Random(n).randrange(20, 200), 3000) + " " + passage + ". " + prose(f"b{k}{c}", 80, 3000)
            rows.append((n, text))
            shared[n] = (k * copies, text.index(passage), text.index(passage) + len(passage))
            n += 1
    rows += [(1000 + k, prose(f"c{k}", 300, 3000)) for k in range(40)]
    return rows, shared


def test_planted_passages_are_found_and_clean_texts_left_alone(docs):
    rows, shared = planted()
    got = op7.repeated_passages(docs(rows, clashing=True)).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append(r)
    assert not {d for d in found if d >= 1000}
    assert len(found) >= 0.97 * len(shared)
    for d, spans in found.items():
        first, a, b = shared[d]
        for s in spans:
            assert a - 2 <= s.start < s.end <= b + 2 and s.first_doc_id == first and s.kept == (d == first)


def test_texts_without_repeats(docs):
    rows, shared = planted(5, 3)
    df = docs([*rows, (None, rows[0][1]), (5000, None)], clashing=True)
    cut = op7.without_repeats(df, op7.repeated_passages(df))
    assert cut.columns == df.columns
    after = {r["doc_id"]: r["text"] for r in cut.collect()}
    spans = {}
    for r in op7.repeated_passages(df).collect():
        if not r.kept:
            spans.setdefault(r.doc_id, []).append((r.start, r.end))
    for d, text in rows:
        want, at = "", 0
        for a, b in sorted(spans.get(d, [])):
            want, at = want + text[at:a], b
        assert after[d] == want + text[at:]
    assert after[None] == rows[0][1] and after[5000] is None


def test_odd_rows(docs):
    rows = odd_rows(3000)
    got = op7.repeated_passages(docs(rows, clashing=True)).collect()
    assert {(r.doc_id, r.kept) for r in got} == {(5, True), (6, False)}  # 7 is in capitals, 8 to 10 are alone
    assert all((r.start, r.end) == (0, len(rows[5][1])) for r in got)
    assert op7.repeated_passages(docs([])).collect() == []


def test_repeats_inside_a_document_if_asked(docs):
    passage = prose("in", 60, 3000)
    rows = [(1, passage + " and then " + prose("x", 100, 3000) + " " + passage), (2, prose("y", 100, 3000))]
    assert op7.repeated_passages(docs(rows)).collect() == []
    first, second = sorted(op7.repeated_passages(docs(rows), across=False).collect(), key=lambda r: r.start)
    assert first.kept and not second.kept and first.doc_id == second.doc_id == 1


def test_query_finds_long_passages_of_small_tables(spark):
    sf, n = "/root/testdata/sf0.01", 51
    rows = [tuple(r) for r in queries.documents(spark, sf).select("doc_id", "text").collect()]
    held = {}
    for doc, text in rows:
        words = text.split(" ")
        for i in range(len(words) - n + 1):
            held.setdefault(tuple(words[i : i + n]), set()).add(doc)
    truth = {d for docs in held.values() if len(docs) > 1 for d in docs}
    got = {r.doc_id for r in queries.op7_substring_dedup(spark, sf).collect()}
    assert len(truth) > 100 and len(truth - got) <= 0.02 * len(truth)


def tokens(seed, n, letters):
    """``n`` seeded words of the given lengths."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=rng.choice(letters))) for _ in range(n))


def test_every_planted_passage_is_found_to_its_edges(docs):
    """Words of one or two characters, short ones and prose; both texts around a passage differ."""
    rows, want = [], {}
    for k in range(120):
        letters = ((1, 2), (2, 3, 4), (3, 6, 9))[k % 3]
        passage = tokens(f"p{k}", 51, letters)
        for c in range(2):
            text = f"{tokens(f'a{k}{c}', 5 + k + c, letters)} <{c} {passage} {c}> {tokens(f'b{k}{c}', 30, letters)}"
            want[2 * k + c] = (text.index(passage), text.index(passage) + len(passage), 51, 2 * k)
            rows.append((2 * k + c, text))
    got = op7.repeated_passages(docs(rows, clashing=True)).collect()
    assert {r.doc_id: (r.start, r.end, r.n_words, r.first_doc_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.doc_id % 2 == 0) for r in got)


def test_any_shared_words_of_the_least_length_share_a_seed():
    for k in range(200):
        passage = tokens(f"s{k}", op7.MIN_WORDS, ((1,), (1, 2), (5, 9))[k % 3])
        owner, _, digest = op7.seed_texts([f"{tokens(f'x{k}{c}', 20 + c, (1, 2))} {passage} {tokens(f'y{k}{c}', 20, (1, 2))}" for c in range(2)])
        assert {*digest[owner == 0].tolist()} & {*digest[owner == 1].tolist()}


def test_query_finds_every_long_passage_of_small_tables(spark):
    sf, n = "/root/testdata/sf0.01", 51
    held = {}
    for doc, text in queries.documents(spark, sf).select("doc_id", "text").collect():
        words = (text or "").split(" ")
        for i in range(len(words) - n + 1):
            held.setdefault(tuple(words[i : i + n]), set()).add(doc)
    truth = {d for found in held.values() if len(found) > 1 for d in found}
    assert truth and truth <= {r.doc_id for r in queries.op7_substring_dedup(spark, sf).collect()}


def test_overlapping_excerpts_keep_one_copy_of_every_word(docs):
    """Documents that hold words 1-200, 100-300 and 150-300 of an article, and two chains of excerpts."""
    rows = []
    for k, cuts in enumerate([[(0, 200), (100, 300), (150, 300)], [(150, 300), (0, 200), (100, 300)], [(i, i + 60) for i in range(0, 241, 30)]]):
        words = [f"{w}{k}x{i}" for i, w in enumerate(prose(f"article{k}", 300, 3000).split())]
        rows += [(100 * k + d, f"{prose(f'u{k}{d}', 30, 3000)} {' '.join(words[a:b])} {prose(f'v{k}{d}', 30, 3000)}") for d, (a, b) in enumerate(cuts)]
    df = docs(rows)
    passages = op7.repeated_passages(df)
    left = " ".join(r["text"] for r in op7.without_repeats(df, passages).collect()).split()
    marked = [w for w in left if w[-1].isdigit()]
    assert sorted(marked) == sorted({w for _, t in rows for w in t.split() if w[-1].isdigit()})
    got = [tuple(r) for r in passages.drop("part").filter("doc_id < 100").orderBy("doc_id", "start").collect()]
    assert [(d, n, copied, first, kept) for d, _, _, n, copied, first, kept in got] == [
        (0, 100, 0, 0, True), (1, 200, 100, 0, False), (1, 200, 0, 1, True), (2, 150, 150, 0, False),
    ]


SLOW_WORD = re.compile("[\u0e00-\u0eff\u1000-\u10bf\u1780-\u17ff\u3040-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]|"
                       "[^\0\t-\r \u0e00-\u0eff\u1000-\u10bf\u1780-\u17ff\u3040-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


def slow_words(text):
    return [m.span() for m in SLOW_WORD.finditer(text)]


def test_words_of_spaced_and_unspaced_scripts():
    rng = random.Random(8)
    alphabet = ["a", "bc", " ", "\n", "é", "漢", "字", "か", "ไ", "ມ", "က", "ក", "\U00020001", "€", "’", "한", "\U0001f600", "豈", "、"]
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randrange(0, 40)))
        words = op7.Words(text)
        assert [words.places(k, k + 1) for k in range(len(words))] == slow_words(text)


def slow_passages(rows):
    """Longest shared runs of 24 words or more, where no words are in more than two documents: {(doc, start, end, n)}."""
    found = set()
    split = [(d, t, slow_words(t)) for d, t in rows]
    for i, (d, t, w) in enumerate(split):
        for e, u, x in split[i + 1 :]:
            at = {}
            for k, (a, b) in enumerate(x):
                at.setdefault(u[a:b], []).append(k)
            for k in range(len(w)):
                for m in at.get(t[slice(*w[k])], ()):
                    n = 1
                    while k + n < len(w) and m + n < len(x) and t[w[k][0] : w[k + n][1]] == u[x[m][0] : x[m + n][1]]:
                        n += 1
                    before = k and m and t[w[k - 1][0] : w[k][1]] == u[x[m - 1][0] : x[m][1]]
                    if n >= op7.MIN_WORDS and not before:
                        found |= {(d, w[k][0], w[k + n - 1][1], n), (e, x[m][0], x[m + n - 1][1], n)}
    return found


def han(seed, n):
    rng = random.Random(seed)
    return "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n))


def test_all_passages_of_random_texts(docs):
    """Words and Han in one text, shared runs of 5 to 80 words: spans and numbers of words as from comparing all pairs."""
    rng = random.Random(11)
    texts = {d: [] for d in range(24)}
    for k in range(60):
        n = rng.randrange(5, 80)
        passage = han(f"h{k}", n) if k % 3 == 0 else tokens(f"p{k}", n, (3, 6, 9))
        for d in rng.sample(sorted(texts), 2):
            texts[d] += [tokens(f"a{k}{d}", rng.randrange(1, 30), (4, 7)), passage, han(f"b{k}{d}", rng.randrange(1, 30))]
    rows = [(d, rng.choice([" ", "\n", "  "]).join(parts)) for d, parts in texts.items()]
    got = op7.repeated_passages(docs(rows, clashing=True)).collect()
    want = slow_passages(rows)
    assert {(r.doc_id, r.start, r.end, r.n_words) for r in got} == want and len(got) == len(want) > 50


def test_text_without_white_space(docs):
    passage = han("long", 3000)
    rows = [(1, han("x", 500) + passage + han("y", 700)), (2, han("z", 90) + passage), (3, han("clean", 4000))]
    got = sorted(op7.repeated_passages(docs(rows)).collect())
    assert [(r.doc_id, r.start, r.end, r.n_words, r.kept) for r in got] == [(1, 500, 3500, 3000, True), (2, 90, 3090, 3000, False)]


def test_one_id_with_several_texts(docs):
    """Each text keeps its own spans; a text that shares nothing stays whole."""
    first, second = prose("one", 60, 3000), prose("two", 60, 3000)
    rows = [
        (1, f"{first} {prose('u', 40, 3000)} {second}"), (2, f"{prose('v', 30, 3000)} {first}"), (2, f"{second} {prose('w', 200, 3000)}"),
        (2, prose("x", 300, 3000)), (2, prose("x", 300, 3000)),
    ]
    df = docs(rows, clashing=True)
    passages = op7.repeated_passages(df)
    assert passages.filter("doc_id = 1 and part != 0").count() == 0
    left = sorted(r["text"] for r in op7.without_repeats(df, passages).filter("doc_id = 2").collect())
    assert left == sorted([prose("v", 30, 3000) + " ", " " + prose("w", 200, 3000), prose("x", 300, 3000), prose("x", 300, 3000)])
    spans = {(r.start, r.end) for r in passages.filter("doc_id = 2").collect()}
    assert spans == {(len(prose("v", 30, 3000)) + 1, len(rows[1][1])), (0, len(second))}
