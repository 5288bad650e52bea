import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Column names that operators use for themselves.
CLASHING = [
    "row", "size", "pattern", "order", "copies", "rep", "label", "key", "block", "shard", "first", "start", "end",
    "words", "found", "taken", "kept", "count", "lang_pred", "score", "spans", "u", "v", "_text", "_words", "bound",
]


class Docs:
    def __init__(self, spark):
        self.spark = spark

    def __call__(self, rows, clashing=False):
        """Rows (doc_id, text[, lang[, source]]) as a documents table."""
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = self.spark.createDataFrame(full, SCHEMA)
        if clashing:
            df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
        return df


@pytest.fixture(scope="session")
def docs(spark):
    return Docs(spark)


def prose(seed, n, vocabulary=400):
    """``n`` seeded words."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(random.Random(f"w{k}").choices(letters, k=3 + k % 7)) for k in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_rows(long_words=30_000):
    """Null, empty, blank, short, repeated, tied and very long texts; null columns."""
    text = prose(1, 80)
    return [
        (0, None, None, None), (1, "", "en", "a"), (2, " \t\n ", "en", "a"), (3, "one", "en", "b"),
        (4, "Two words", None, "b"), (5, text, "en", "a"), (6, text, "en", None), (5, text, "en", "a"),
        (7, text.upper(), "de", "é"), (8, prose(2, long_words), "de", "b"), (9, "é ü ñ 漢字 \U0001f600", "fr", "c"),
        (None, prose(3, 40), "en", "a"), (10, "x" * 5000, "en", "c"),
    ]
