import itertools
import random
import zlib

import numpy as np
import pytest

from wardline.llm import op11_toxicity as op11
from wardline.llm import queries

from .conftest import odd_rows, prose

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ["blockhead", "numbskull", "dimwit", "scoundrel"]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def plain_space(window, alphabet):
    """Weights of all subsequences, one by one, and the length of the vector of single occurrences."""
    place = [None if not (c.isalpha() or c in (op11.BEGIN, op11.END)) else c for c in window]
    found, length = {}, 0.0
    for picked in itertools.combinations(range(len(window)), op11.ORDER):
        span = picked[-1] - picked[0] + 1
        letters = tuple(place[i] for i in picked)
        if span <= op11.SPAN and None not in letters:
            weight = op11.DECAY ** (span - op11.ORDER)
            length += weight**2
            if all(c in alphabet for c in letters):
                found[letters] = found.get(letters, 0.0) + weight
    return found, length**0.5


def plain_kernel(a, b, alphabet):
    (x, m), (y, n) = plain_space(a, alphabet), plain_space(b, alphabet)
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / (m * n) if m and n else 0.0


def test_kernel_is_the_sum_over_shared_subsequences():
    rng = random.Random(1)
    strings = [op11.marked("".join(rng.choices("abcé.* z漢", k=rng.randint(0, 14)))) for _ in range(40)]
    alphabet = {op11.BEGIN, op11.END, *"abcé"}
    got = op11.kernel(strings, strings[:10], op11.codes_of("abcé"))
    want = [[plain_kernel(a, b, alphabet) for b in strings[:10]] for a in strings]
    assert got == pytest.approx(np.array(want))


def test_folded_weights_equal_the_sum_over_landmarks():
    positive, negative = {"blockhead": 9, "dimwit": 7}, {w: 1 for w in prose(3, 60).split()}
    landmarks = [*positive, *list(negative)[:9]]
    codes = op11._codes(landmarks)
    model = op11.machine(positive, negative, landmarks, codes)
    tried = ["blockhead", "b.lock-head", "dim wit", "clock", "ahead", "", "x", "1234"]
    k = op11.kernel([op11.marked(w) for w in tried], [op11.marked(m) for m in landmarks], codes)
    space = np.zeros((len(model.weights), len(landmarks)))
    for column, mark in zip(space.T, landmarks):
        used, weights = op11.subsequences(op11.marked(mark), codes)
        column[used] = weights
    alphas = np.linalg.lstsq(space, model.weights, rcond=None)[0]
    assert model.values(tried) == pytest.approx(k @ alphas + model.offset, abs=1e-6)


def test_one_at_a_time_or_in_parts(monkeypatch):
    model = op11.machine({"dimwit": 5}, {"within": 1, "dime": 1}, ["dimwit", "within"], op11.codes_of("dimwthn"))
    words = prose(5, 300).split()
    whole = model.values(words)
    monkeypatch.setattr(op11, "_AT_ONCE", 7)
    assert model.values(words) == pytest.approx(whole)


def test_windows_cover_words_fragments_and_long_words():
    assert op11.windows_of("You d i m wi t! it is") == ["you", "d", "i", "m", "wi", "t!", "it", "is", "d i m wi t! it is"]
    long = "".join(random.Random(1).choices("abcdefgh", k=500)) + "dimwit"
    found = op11.windows_of(long)
    assert all(len(w) <= op11.MOST for w in found) and any("dimwit" in w for w in found)
    assert all(any(long[k : k + 16] in w for w in found) for k in range(len(long) - 16))
    assert op11.windows_of(None) == op11.windows_of(" \n ") == []


def corpus(n=240, every=4):
    """Documents whose toxic ones hold insults in one sentence or more."""
    rows, labels = [], []
    for k in range(n):
        rng, text = random.Random(k), prose(f"t{k}", 60).split()
        toxic = k % every == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(INSULTS))
        for at in range(9, len(text), 12):
            text[at] += "."
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_insults_are_learned_and_tolerate_inserted_characters(spark, docs):
    rows, labels = corpus()
    base = prose("clean", 50)
    forms = ["num.bsk*ull", "n u m b s k u l l", "dimm-wit", "sco__undrel", "SCOUNDREL!", "bl0ockhead", "blockheads", "numb skull"]
    more = [(1000 + k, f"{base}. you {f} {base}") for k, f in enumerate(forms)] + [(2000, base), (2001, ""), (2002, None)]
    table = docs(rows + more)
    got = {r.doc_id: r for r in op11.toxicity(table, spark.createDataFrame(labels, LABELS)).collect()}
    assert all(got[k].predicted == t for k, _, t in labels), [k for k, _, t in labels if got[k].predicted != t]
    assert [f for k, f in enumerate(forms) if not got[1000 + k].predicted] in ([], ["numb skull"])
    assert not any(got[k].predicted for k in (2000, 2001, 2002))
    assert got[2001].score == got[2002].score and all(0 <= r.score <= 1 for r in got.values())
    model = op11.train(table, spark.createDataFrame(labels, LABELS))
    found = op11.toxic_sentences(docs([(7, f"A fine day. You dimwit, go. {base}.\nNothing here.")]), model).collect()
    assert [(r.doc_id, r.start, r.end, r.sentence) for r in found] == [(7, 12, 27, "You dimwit, go.")]


def test_held_out_labels_teach_nothing(spark, docs):
    rows, labels = corpus(120)
    moved = [(k, 1, 1 - t if held_out(k) else t) for k, _, t in labels]
    a = op11.toxicity(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    b = op11.toxicity(docs(rows), spark.createDataFrame(moved, LABELS)).collect()
    assert sorted(a) == sorted(b) and {r.doc_id for r in a if r.held_out} == {k for k, _ in rows if held_out(k)}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf, "labels").collect()}
    got = queries.op11_toxicity(spark, sf).collect()
    assert len(got) == len({r.doc_id for r in got}) == 10_000
    test = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    caught = sum(p for t, p in test if t) / sum(t for t, _ in test)
    wrong = sum(p for t, p in test if not t) / sum(not t for t, _ in test)
    assert len(test) > 700 and caught > 0.88 and wrong < 0.015


def test_copies_of_one_text_count_once(spark, docs):
    text = ". ".join(prose(f"noise{k}", 12) for k in range(9))
    rows = [(k, f"{text}. {prose(f'n{k}', 2)}") for k in range(60)]
    found = op11.window_counts(op11.families(docs(rows).selectExpr("text", "1 AS toxic"))).collect()
    assert max(r.toxic for r in found) < 20


@pytest.mark.parametrize("labels", [[], [(5, 1, 1)], [(5, 1, None), (6, 0, 0), (None, 1, 1)]])
def test_nothing_to_learn(spark, docs, labels):
    got = op11.toxicity(docs(odd_rows(500)), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(odd_rows(500)) and {(r.score, r.predicted) for r in got} == {(0.0, 0)}


def test_odd_rows(spark, docs):
    rows, labels = corpus(160)
    odd = [(None if i is None else 5000 + i, *r) for i, *r in odd_rows(20_000)]
    more = [*labels, (1, 0, 0), (None, 1, 1), (9999, 1, 1), (3, 1, None)]
    df = docs([*rows, *odd], clashing=True)
    got = op11.toxicity(df, spark.createDataFrame(more, LABELS)).collect()
    assert len(got) == len(rows) + len(odd)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert not any(r.predicted for r in got if r.doc_id is None or r.doc_id >= 5000)
    assert op11.toxicity(docs([]), spark.createDataFrame(more, LABELS)).collect() == []
