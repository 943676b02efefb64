"""DuckDB SQL of the queries of this package that SQL can express."""

from __future__ import annotations

from cairn.llm import rules

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
reach(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, coalesce(min(y), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON x = d.doc_id GROUP BY d.doc_id"""

OP7 = """
WITH d AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13)) <> '') AS ls FROM documents),
win AS (SELECT doc_id, i - 1 AS pos, array_to_string(list_transform(ls[i:i + 2], lambda x: trim(x, chr(32) || chr(9) || chr(13))), chr(10)) AS g
        FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d)),
later AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS r FROM win) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT later.pos + k) AS pos FROM later, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
new AS (SELECT d.*, pos, array_to_string(list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(pos, i)),
                                                         lambda i: ls[i + 1]), chr(10)) AS fresh
        FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CASE WHEN pos IS NULL THEN text ELSE fresh END AS text, lang, source,
       CASE WHEN pos IS NULL THEN n_chars ELSE length(fresh) END AS n_chars FROM new"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


_CLOSING = "".join(rf"\{c}" if c in ".?)]\"'" else c for c in rules.CLOSING)
_WORDS_OF = f"len(regexp_extract_all(x, '{WORD}'))"
_FAULT = f"""({_WORDS_OF} > 0 AND (
  regexp_matches(lower(x), '{_quoted(rules.BOILERPLATE.pattern)}')
  OR len(regexp_extract_all(x, '{_quoted(rules.SEPARATORS.pattern)}')) >= 3
  OR ({_WORDS_OF} < {rules.SHORT_LINE} AND NOT regexp_matches(x, '[{_quoted(_CLOSING)}][\x20\x09-\x0D]*$'))
  OR ({_WORDS_OF} >= {rules.SHORT_LINE} AND 2 * len(regexp_extract_all(x, '{_quoted(rules.MARKS.pattern)}')) >= {_WORDS_OF})))"""

OP9 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS ws, string_split(text, chr(10)) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             list_filter(ls, lambda x: {_WORDS_OF} > 0) AS filled,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             list_sum(list_transform(list_filter(ls, lambda x: NOT {_FAULT}), lambda x: {_WORDS_OF})) AS words_kept
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines, n_repeat_words,
       n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words)
         AND 100 * coalesce(words_kept, 0) >= {rules.MIN_KEPT} * n_words AS kept FROM f"""

OP12 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same AND other <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 10"""

SQL: dict[str, str] = {"op1_ngram_jaccard_join": OP1, "op7_line_dedup": OP7, "op9_quality_rules": OP9,
                       "op12_hard_negative_mining": OP12}
