import random
import re
import tempfile
import time

import pytest

from wardline.llm import op9_license_scan as op9
from wardline.llm import queries

from .conftest import odd_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    places = []
    for phrase, label in op9.PHRASES.items():
        wanted = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def distance(pattern, text):
    """Fewest edits from the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def plain_labels(text):
    joined = " " + b" ".join(op9.normal_words(text)).decode() + " "
    return {n.label for n in op9.NOTICES if distance(n.text, joined) <= n.edits}


def compare(docs, texts, **kw):
    got = op9.license_scan(docs(list(enumerate(texts)), **kw)).collect()
    for r, text in zip(sorted(got, key=lambda r: r.doc_id), texts, strict=True):
        assert tuple(r)[1:6] == plain_base(text)
        labels = {x for x in r.base_labels.split(",") if x} | plain_labels(text)
        assert r.labels == ",".join(sorted(labels)), text
        assert 0 <= r.score <= 1 and (r.score == 1 if r.n_base else (r.score > 0) == bool(labels))


def misspelt(text, seed, edits):
    rng, chars = random.Random(seed), list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("qv"))
    return "".join(chars)


def test_phrases(docs):
    compare(docs, [
        "Licensed under the Apache License, Version 2.0.", "GNU\nGeneral  Public-License gnu general public license", "mit license mit license",
        "CC BY-NC 4.0", "cc bypass", "xmit license", "mit licenses", "mit license", "MIT é License", "apache licenseé", "CC BY CC BY cc  by",
    ])


def test_misspelt_notices(docs):
    texts = [
        f"{prose(k, 15)} {misspelt(n.text, k, k % (n.edits + 2))} {prose(k + 1, 15)}"
        for k in range(60) for n in [op9.NOTICES[k % len(op9.NOTICES)]]
    ]
    compare(docs, texts)


@pytest.mark.parametrize("notice", op9.NOTICES, ids=lambda n: n.text[:20])
def test_spans_cover_the_notice(notice):
    scanner = op9.Scanner()
    before = prose("before", 7)
    text = f"{before} {misspelt(notice.text, 3, 1)} {prose('after', 5)}"
    spans = [s for s in scanner.fuzzy(" " + b" ".join(op9.normal_words(text)).decode() + " ") if s.label == notice.label]
    assert any(abs(s.first - 7) <= 1 and s.likeness >= 1 - notice.edits / len(notice.text) for s in spans)


def test_a_piece_is_always_left_whole():
    """Any notice with its edits holds one of its pieces unchanged."""
    scanner = op9.Scanner()
    for seed in range(200):
        notice = op9.NOTICES[seed % len(op9.NOTICES)]
        text = misspelt(notice.text, seed, notice.edits)
        assert any(True for _ in scanner.pieces.iter(text))


def test_odd_rows(docs):
    compare(docs, [r[1] for r in odd_rows(2000)], clashing=True)
    assert op9.license_scan(docs([])).collect() == []


def test_query_over_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    got = queries.op9_license_scan(spark, sf).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        assert tuple(r)[1:6] == plain_base(texts[r.doc_id])
        assert {*r.base_labels.split(",")} <= {*r.labels.split(",")} | {""}
    assert sum(r.n_base for r in got) > 5


@pytest.mark.parametrize(("text", "want"), [
    ("gnu generl public license gnu generl public license gnu generl public licens gnu general public license", [(0, 4), (4, 8), (8, 12), (12, 16)]),
    ("the gnu genral publik license or gnu general public license", [(1, 5), (6, 10)]),
    ("gnu general public license and gnu generl public license and gnu genral publc license", [(0, 4), (5, 9), (10, 14)]),
])
def test_misspelt_notices_beside_exact_ones_keep_their_spans(text, want):
    spans = op9.Scanner().fuzzy(f" {text} ")
    assert sorted((s.first, s.last) for s in spans if s.label == "gpl") == want


def test_time_grows_with_the_notices_of_one_text():
    scanner, took = op9.Scanner(), {}
    for n in (2_000, 16_000):
        text = " ".join(["some code under the mit license and gnu generl public license"] * (n // 2))
        began = time.process_time()
        found = scanner.scan(text)
        took[n] = time.process_time() - began
        assert found[1] == n // 2 and len(found[-1].split(",")) >= n // 2
    assert took[16_000] < 24 * max(took[2_000], 0.02)


def test_notices_from_a_file(spark, docs):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    texts = [prose(f"notice{k}", 6) for k in range(100)]
    with open(f"{folder}/notices.csv", "w") as f:
        f.write("label,text,edits\n" + "".join(f"n{k},{t.title()}!,2\n" for k, t in enumerate(texts)))
    notices = op9.read_notices(spark, folder)
    assert len(notices) == 100 and {n.text for n in notices} == set(texts)
    rows = [(k, f"{prose(f'b{k}', 20)} {misspelt(t, k, 2)} {prose(f'a{k}', 20)}") for k, t in enumerate(texts)]
    got = {r.doc_id: r.labels for r in op9.license_scan(docs(rows), notices).collect()}
    assert all(f"n{k}" in got[k].split(",") for k in range(100))
    with open(f"{folder}/notices.csv", "w") as f:
        f.write("label,text,edits\nx,abc,3\n")
    with pytest.raises(ValueError, match="not a notice"):
        op9.read_notices(spark, folder)
