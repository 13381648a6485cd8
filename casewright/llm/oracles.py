"""DuckDB statements for the results of the text operators that SQL can state."""

from __future__ import annotations

from casewright.llm import licenses, repetition, substring

_WORDS = r"""
w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)
)"""


def _windows(name: str, size: int) -> str:
    """Windows of ``size`` words as ``name``: doc_id, first word and joined words."""
    frame = f"(PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)"
    return f"""
{name} AS (
  SELECT doc_id, i, s FROM (
    SELECT doc_id, i, string_agg(word, ' ') OVER {frame} AS s, count(*) OVER {frame} AS n FROM w
  ) WHERE n = {size}
)"""


def _covered(name: str, hits: str, size: int) -> str:
    """Words that lie in a window of ``hits``."""
    return f"""
{name} AS (
  SELECT doc_id, i, word, max(hit) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS covered
  FROM (SELECT w.*, h.i AS hit FROM w LEFT JOIN {hits} h ON h.doc_id = w.doc_id AND h.i = w.i)
)"""


OP1 = f"""
WITH {_WORDS}, {_windows("v", substring.WINDOW)},
often AS (SELECT s FROM v GROUP BY s HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM v SEMI JOIN often USING (s)),
{_covered("c", "hits", substring.WINDOW)}
SELECT d.doc_id, count(c.word) AS n_words, count(c.word) FILTER (WHERE c.covered) AS n_removed,
  sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.i) FILTER (WHERE NOT c.covered), '')) AS kept_sha256
FROM documents d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id
"""

_LEAST, _LONG = repetition.LEAST_REPEAT, repetition.MAX_LONGEST + 1

OP10 = rf"""
WITH {_WORDS},
{_windows("v3", repetition.REPEAT_WINDOW)}, {_windows("v8", _LEAST)}, {_windows("vl", _LONG)},
h3 AS (SELECT doc_id, unnest(list(i)) AS i FROM v3 GROUP BY doc_id, s HAVING count(*) > 1),
h8 AS (SELECT doc_id, unnest(list(i)) AS i FROM v8 GROUP BY doc_id, s HAVING count(*) > 1),
hl AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM vl GROUP BY doc_id, s HAVING count(*) > 1)),
{_covered("c3", "h3", repetition.REPEAT_WINDOW)}, {_covered("c8", "h8", _LEAST)},
words AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
    count(*) FILTER (WHERE covered) AS n_repeat_words FROM c3 GROUP BY doc_id
),
cover AS (SELECT doc_id, count(*) FILTER (WHERE covered) AS repeat_covered FROM c8 GROUP BY doc_id),
lines AS (
  SELECT doc_id, (sum(n) - count(*))::BIGINT AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS n FROM (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
    ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line
  ) GROUP BY doc_id
),
j AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT
      AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(repeat_covered, 0) AS repeat_covered, hl.doc_id IS NOT NULL AS long_repeat
  FROM documents d LEFT JOIN words USING (doc_id) LEFT JOIN cover USING (doc_id)
  LEFT JOIN lines USING (doc_id) LEFT JOIN hl USING (doc_id)
),
b AS (
  SELECT *, n_words < {repetition.MIN_WORDS}
    OR 100 * n_repeat_words > {repetition.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM j
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeat_covered, base_failed,
  NOT base_failed AND NOT repeat_covered > {repetition.MAX_COVERED} * n_words AND NOT long_repeat AS kept
FROM b
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _normal(text: str) -> str:
    return rf"regexp_replace(translate({text}, '{_UPPER}', '{_LOWER}'), '[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]', ' ', 'g')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda k: {words}[k] || ' ' || {words}[k + 1]))"


OP9 = rf"""
WITH templates AS (
  SELECT template, licence, {_bigrams("words")} AS grams FROM (
    SELECT template, licence, regexp_extract_all({_normal("text")}, '[^\x20\x09-\x0D]+') AS words FROM (VALUES
      {", ".join(f"({k}, {_literal(n)}, {_literal(t)})" for k, (n, t) in enumerate(licenses.TEMPLATES))}
    ) AS t(template, licence, text))
),
known AS (SELECT DISTINCT unnest(grams) AS gram FROM templates),
split AS (SELECT doc_id, string_split({_normal("coalesce(text, '')")}, chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS n FROM split),
worded AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM lines),
touched AS (
  SELECT DISTINCT doc_id, n FROM (SELECT doc_id, n, unnest({_bigrams("words")}) AS gram FROM worded)
  SEMI JOIN known USING (gram)
),
islands AS (
  SELECT doc_id, n, words, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS island
  FROM worded SEMI JOIN touched USING (doc_id, n)
),
pieces AS (
  SELECT doc_id, 'line' AS scope, n AS first_line, n AS last_line, words FROM islands
  UNION ALL
  SELECT doc_id, 'run', min(n), max(n), flatten(list(words ORDER BY n)) FROM islands
  GROUP BY doc_id, island HAVING count(*) > 1
),
grams AS (SELECT doc_id, scope, first_line, last_line, {_bigrams("words")} AS grams FROM pieces),
shared AS (
  SELECT g.doc_id, g.scope, g.first_line, g.last_line, t.template, any_value(t.licence) AS licence,
    2.0 * count(*) / any_value(len(g.grams) + len(t.grams)) AS dice
  FROM (SELECT *, unnest(grams) AS gram FROM grams) g
  JOIN (SELECT *, unnest(grams) AS gram FROM templates) t USING (gram)
  GROUP BY g.doc_id, g.scope, g.first_line, g.last_line, t.template
)
SELECT doc_id, scope, first_line::BIGINT AS first_line, last_line::BIGINT AS last_line, licence,
  round(dice, 6)::DOUBLE AS dice
FROM shared WHERE dice >= {licenses.LEAST_DICE}
QUALIFY row_number() OVER (
  PARTITION BY doc_id, scope, first_line, last_line ORDER BY dice DESC, template) = 1
"""

OP12 = """
WITH scaled AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: 256 * x::DOUBLE) AS v
  FROM embeddings
),
vectors AS (
  SELECT row_number() OVER () AS uid, vec_id, label, list_transform(v, lambda x: floor(x)::BIGINT) AS v
  FROM scaled
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: coalesce(isfinite(x), false))) = len(v)
),
scored AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.uid, b.vec_id,
    coalesce(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])), 0)::BIGINT
      AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.uid <> b.uid
),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id, n.uid)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id, n.uid) <= 10
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op9_license_scan": OP9,
    "op10_quality_rules": OP10,
    "op12_hard_negatives": OP12,
}
