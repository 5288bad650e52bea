"""Plain SQL for the operators whose results it can state; another engine runs it on the same tables."""

from __future__ import annotations

from wardline.llm import op2_decontamination as leaks
from wardline.llm import op5_quality_rules as quality
from wardline.llm import op8_secret_scan as secrets
from wardline.llm import op12_importance_resampling as resampling

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str, separators: str, n: int) -> str:
    """Distinct shingles as lists of words: (key, s).  Fewer words than ``n`` are one shingle."""
    return f"""
  SELECT DISTINCT {key}, unnest(CASE
      WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n - 2}), lambda i: w[i:i + {n - 1}])
      WHEN len(w) > 0 THEN [w] ELSE [] END) AS s
  FROM (SELECT {key}, list_filter(regexp_split_to_array({_LOWER}, '{separators}'), lambda x: x <> '') AS w
        FROM {table})"""


def _line(table: str, key: str, separators: str) -> str:
    """The words of each text in a row, a blank before and after each: (key, n, line)."""
    return f"""
  SELECT {key}, len(w) AS n, ' ' || array_to_string(w, ' ') || ' ' AS line
  FROM (SELECT {key}, list_filter(regexp_split_to_array({_LOWER}, '{separators}'), lambda x: x <> '') AS w FROM {table})"""


# Every item against every document by the shingles they share; items shorter than a shingle by their words.
DECONTAMINATION = f"""
WITH items AS (SELECT * FROM ({_shingles('benchmark', 'item_id', leaks.SEPARATORS, leaks.WORDS)}) WHERE len(s) = {leaks.WORDS}),
docs AS ({_shingles('documents', 'doc_id', leaks.SEPARATORS, leaks.WORDS)}),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS k FROM items JOIN docs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, k AS n_shared, n AS n_item_shingles, k / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * k >= {leaks.PERCENT} * n
UNION ALL
SELECT doc_id, item_id, 1, 1, 1.0
FROM ({_line('benchmark', 'item_id', leaks.SEPARATORS)}) i
  JOIN ({_line('documents', 'doc_id', leaks.SEPARATORS)}) d ON contains(d.line, i.line)
WHERE i.n BETWEEN 1 AND {leaks.WORDS - 1}
"""

# Every pair of documents that share a shingle, and what links reach.
NEAR_DUPLICATES = f"""
WITH RECURSIVE shingles AS MATERIALIZED ({_shingles('documents', 'doc_id', '[ \\x09-\\x0D]+', 3)}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * k >= 85 * (a.n + b.n - k)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, w.v FROM reach r JOIN ways w ON w.u = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: secrets.Kind) -> str:
    """All matches of a kind with their places: (r, kind, start, stop, found)."""
    pattern = _quoted(kind.pattern)
    return f"""
  SELECT r, '{kind.name}' AS kind, first AS start, first + length(found) AS stop, found
  FROM (SELECT r, found[i] AS found,
      CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS first
    FROM (SELECT r, found, gaps, unnest(range(1, len(found) + 1)) AS i
      FROM (SELECT r, regexp_extract_all(text, {pattern}) AS found, regexp_split_to_array(text, {pattern}) AS gaps
        FROM docs)))"""


def _kept(kind: secrets.Kind) -> str:
    if not kind.least:
        return _matches(kind)
    group = f"regexp_extract(found, {_quoted('^' + kind.pattern + '$')}, 1)"
    return f"SELECT * FROM ({_matches(kind)}) WHERE length({group}) >= {kind.least}"


_BITS = " ".join(f"WHEN regexp_full_match(found, {_quoted(c.pattern)}) THEN {c.bits}" for c in secrets.CLASSES)
_ALLOWED = " OR ".join(f"regexp_full_match(found, {_quoted(a)})" for a in secrets.ALLOWED)

# Windows as rows; the engine's own entropy.
SECRETS = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({' UNION ALL '.join(map(_kept, secrets.KINDS))}),
suspects AS ({_matches(secrets.CANDIDATE)}),
windows AS (
  SELECT *, unnest(range(1, length(found) - {secrets.WINDOW - 2})) AS k
  FROM (SELECT *, CASE {_BITS} END AS bits FROM suspects WHERE NOT ({_ALLOWED}))),
hot AS (
  SELECT r, start + min(k) - 1 AS start, start + max(k) - 1 + {secrets.WINDOW} AS stop
  FROM windows
  WHERE list_aggregate(string_split(found[k:k + {secrets.WINDOW - 1}], ''), 'entropy') >= bits
  GROUP BY r, start, found),
spans AS (
  SELECT r, kind, start, stop FROM base
  UNION ALL
  SELECT r, 'entropy', start, stop FROM hot h
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = h.r AND b.start <= h.start AND b.stop >= h.stop)),
listed AS (
  SELECT r, kind, start, kind || ':' || start || ':' || stop AS span,
    CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END AS place
  FROM spans),
found AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base_spans,
    string_agg(span, ',' ORDER BY start, place) AS spans
  FROM listed GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (r)
"""


def _features(table: str, key: str) -> str:
    """Every word of every text, repeats included: (key, w)."""
    return f"SELECT {key}, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM {table}"


# CRC-32 byte by byte from its table, each distinct word once.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
RESAMPLING = f"""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: {_CRC_STEP})) AS t),
corpus AS MATERIALIZED ({_features('documents', 'doc_id')}),
wanted AS MATERIALIZED ({_features('benchmark', 'item_id')}),
bytes AS (
  SELECT w, list_transform(range(1, strlen(w) + 1), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT)) AS b
  FROM (SELECT w FROM corpus UNION SELECT w FROM wanted)),
buckets AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % {resampling.BUCKETS} AS bucket
  FROM bytes, crc),
s AS (SELECT bucket, count(*) AS n FROM corpus JOIN buckets USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM corpus) + {resampling.BUCKETS}.0::DOUBLE))
    / ((s.n + 1.0::DOUBLE) * ((SELECT count(*) FROM wanted) + {resampling.BUCKETS}.0::DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM corpus JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= {resampling.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, r.rank AS rank
FROM scored LEFT JOIN (SELECT * FROM ranked WHERE rank <= {resampling.PERCENT} * n // 100) r USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op3_minhash_dedup": NEAR_DUPLICATES,
    "op5_quality_rules": quality.ORACLE_SQL,
    "op8_secret_scan": SECRETS,
    "op12_importance_resampling": RESAMPLING,
}
