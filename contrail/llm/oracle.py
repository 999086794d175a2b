"""DuckDB SQL for the training-data queries that SQL can express, over the same whole tables.

Written from the contracts, in other terms than the Spark code where there is
a choice: word windows are window frames over rows, spans are rebuilt from the pieces
between matches, links are all pairs of a label and components a recursion.
The SQL reads ids as unique, which they are in the tables.
"""

from __future__ import annotations

from contrail.llm.quality import RULES, STOP_WORDS, WINDOW

WORD = r"[^\x20\x09-\x0D]+"

_MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, 2.0::DOUBLE * source_size AS most FROM totals),
weighed AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][rank % 3 + 1] AS weight FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
common AS (SELECT arg_min(level, most / weight) AS level FROM levels WHERE level * weight < most),
targets AS (
  SELECT w.*, least(most, coalesce(c.level * weight, most)) AS target FROM weighed w, common c),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rank, floor(t.target + 0.5::DOUBLE)::BIGINT AS wanted,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(s.doc_id::VARCHAR), s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS passes FROM placed),
shares AS (
  SELECT *, passes * size + greatest(least(wanted - passes * source_size - before, size), 0) AS taken,
         before / target AS share
  FROM taken)
SELECT doc_id, size::BIGINT AS size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN CASE rank % 3
         WHEN 0 THEN 2 * (3 * share) / (sqrt(greatest(16 - 4 * (3 * share), 0)) + 4)
         WHEN 1 THEN share
         ELSE 2 * (2 * share) / (sqrt(1 + 4 * (2 * share)) + 1) END END AS position
FROM shares"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 ELSE false END),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, s.b) AS component_id,
       least(e.vec_id, s.b) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN smallest s ON s.a = e.vec_id"""


def _allowed(rule) -> str:
    ok = []
    if rule.low is not None:
        ok.append(f"{rule.numerator}::DOUBLE >= {rule.low}::DOUBLE * {rule.denominator}")
    if rule.high is not None:
        ok.append(f"{rule.numerator}::DOUBLE <= {rule.high}::DOUBLE * {rule.denominator}")
    return f"(n_words < {rule.from_words} OR ({' AND '.join(ok)}))"


_QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM d),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
starts AS (
  SELECT doc_id, i, word = lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS same,
         list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS words
  FROM placed),
found AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words) AS n FROM starts WHERE len(words) = {WINDOW}),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM found, unnest(range(i, i + {WINDOW})) AS t(j) WHERE n > 1 GROUP BY doc_id),
neighbours AS (SELECT doc_id, count(*) AS n FROM starts WHERE same GROUP BY doc_id),
measures AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: x IN ({', '.join(f"'{x}'" for x in STOP_WORDS)})))::BIGINT AS n_stop_words,
         coalesce(e.n, 0)::BIGINT AS n_same_neighbours,
         length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g'))::BIGINT AS n_upper
  FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id LEFT JOIN neighbours e ON e.doc_id = s.doc_id),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(map(_allowed, RULES))} AS kept,
       n_lines, n_stop_words, n_same_neighbours, n_upper
FROM judged"""

#: Kind, pattern as SQL text, group that must reach the least length, least length.
_KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("token", r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
              r"|eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}", 0, 0),
)


def _found(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, string_split_regex(text, '{pattern}') AS gaps,
         regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_extract_all(text, '{pattern}', {group}) AS cores
  FROM d WHERE regexp_matches(text, '{pattern}')"""


_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_found(k, *kind) for k, kind in enumerate(_KINDS))}),
placed AS (
  SELECT doc_id, rank, kind, least, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit, unnest(cores) AS core,
         unnest(range(1, len(hits) + 1)) AS i
  FROM found),
ends AS (
  SELECT doc_id, rank, kind, least, length(hit) AS size, length(core) AS core,
         sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop
  FROM placed),
spans AS (
  SELECT doc_id, rank, stop - size AS start, kind || ':' || (stop - size) || ':' || stop AS span
  FROM ends WHERE core >= least)
SELECT d.doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
       count(*) FILTER (WHERE rank = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id
GROUP BY d.doc_id"""

_JACCARD = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
placed AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
windows AS (
  SELECT doc_id, n, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS gram
  FROM placed),
grams AS (SELECT DISTINCT doc_id, gram FROM windows WHERE len(gram) = 5 OR n < 5 AND i = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 10 * s.n >= 8 * (x.n + y.n - s.n)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, least(d.doc_id, s.b) AS class_id, coalesce(c.n, 0) AS n_links,
       least(d.doc_id, s.b) = d.doc_id AS kept
FROM documents d LEFT JOIN counted c ON c.a = d.doc_id LEFT JOIN smallest s ON s.a = d.doc_id"""

ORACLE: dict[str, str] = {
    "op1_mix_sources": _MIX,
    "op3_embedding_near_dups": _VECTORS,
    "op4_ngram_jaccard_join": _JACCARD,
    "op9_quality_rules": _QUALITY,
    "op10_secret_ledger": _SECRETS,
}
