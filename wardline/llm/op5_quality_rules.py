"""Quality rules as one Spark projection (operator 5).

A table of thresholds over lengths and ratios is compiled into columns of built-in
functions; there is no user function and no shuffle.  Repeated five-word windows are
found inside the row: windows are hashed, a distinct count tells whether any repeats, and
only then are hashes sorted with their places, so long texts cost n log n.

Defined cases: a null, empty or blank text has no words and fails the base rule.  Ratios
over nothing are null and break no rule.  Rows are judged as they come, repeated ones
too.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import once

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARACTERS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent short words of the languages the corpus is known to hold.
STOP_WORDS = """
the of and to in is that for it was with as on are by be this not or from at an
der die das den dem des und ist zu von mit für auf nicht ein eine im sich
le la les de du un une et que en est pour dans qui par sur au
el los las del y con para es se no su al lo una por
""".split()


class Rule(NamedTuple):
    """``measure`` must lie between the limits (null: none) in texts of ``words`` words or more."""

    measure: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("n_words", 10, None),
    Rule("mean_word_chars", 2.5, 12.0),
    Rule("symbol_ratio", None, 0.05),
    Rule("stop_word_ratio", 0.02, None, words=20),
    Rule("dup_line_ratio", None, 0.5),
    Rule("repeat_word_ratio", None, 0.2),
)


def _windows(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside five-word windows that the text holds twice or more."""
    places = F.sequence(F.lit(0), F.col("_n") - WINDOW)
    window = F.transform(places, lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW))))
    df = df.withColumn("_windows", F.when(F.col("_n") > WINDOW, window))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_placed", F.when(repeats, placed))
    same = F.filter(
        F.sequence(F.lit(0), F.size("_placed") - 1),
        lambda k: (F.get("_placed", k)["h"] == F.get("_placed", k + 1)["h"])
        | ((k > 0) & (F.get("_placed", k)["h"] == F.get("_placed", k - 1)["h"])),
    )
    df = df.withColumn("_same", F.when(F.col("_placed").isNotNull(), F.array_sort(F.transform(same, lambda k: F.get("_placed", k)["i"]))))
    covered = F.transform("_same", lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_same", k + 1) - at, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, counts and ratios of the text), one row per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("_text"))
    trimmed = F.btrim("_text", F.lit(WHITE_CHARACTERS))
    df = df.withColumn("_words", F.when(trimmed != "", F.split(trimmed, WHITE)))
    df = df.withColumn("_n", F.coalesce(F.size("_words"), F.lit(0)))
    df = df.withColumn("_n", F.greatest("_n", F.lit(0)))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    df = _windows(df)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE_CHARACTERS)) != "")
    df = df.withColumn("_lines", lines)
    stop = F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS)))
    counts = F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", WHITE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.when(F.col("_n") > 0, stop).otherwise(0).cast("long").alias("n_stop_words"),
    )
    counts = df.select("doc_id", once(counts).alias("_counts")).select("doc_id", "_counts.*")

    def ratio(a: str, b: str) -> Column:
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))

    return counts.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
    )


def broken(rule: Rule) -> Column:
    """Whether a row of measures breaks a rule."""
    value, out = F.col(rule.measure), F.lit(False)
    if rule.least is not None:
        out = out | (value < rule.least)
    if rule.most is not None:
        out = out | (value > rule.most)
    return F.coalesce(out & (F.col("n_words") >= rule.words), F.lit(False))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and verdict of every text: ``kept`` unless the base rule or any other one fails."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = F.concat_ws(",", *(F.when(broken(rule), F.lit(rule.measure)) for rule in rules))
    judged = measures(docs).withColumn("base_failed", base).withColumn("failed_rules", failed)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules",
    )


def _literals(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# The same in plain SQL: windows as rows, measures as list functions.
ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM docs),
windows AS (
  SELECT r, i, list_slice(words, i, i + 4) AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM repeated, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(words, lambda w: w IN ({_literals(STOP_WORDS)}))) AS n_stop
  FROM split LEFT JOIN covered c USING (r)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN n_words < 10 THEN 'n_words' END,
      CASE WHEN n_words > 0 AND (word_chars / n_words < 2.5 OR word_chars / n_words > 12) THEN 'mean_word_chars' END,
      CASE WHEN word_chars > 0 AND n_symbols / word_chars > 0.05 THEN 'symbol_ratio' END,
      CASE WHEN n_words >= 20 AND n_stop / n_words < 0.02 THEN 'stop_word_ratio' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'dup_line_ratio' END,
      CASE WHEN n_words > 0 AND n_repeat_words / n_words > 0.2 THEN 'repeat_word_ratio' END) AS failed_rules
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""
