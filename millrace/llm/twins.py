"""SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

import string

from .quality_rules import CUTOFFS, RULES, Risk

_RISK = Risk()
_WORDS = r"[x FOR x IN regexp_split_to_array({text}, '[\x20\x09-\x0D]+') IF x <> '']"
_SHARE = "CASE WHEN {1} > 0 THEN (1000 * {0}) // {1} ELSE 0 END"
_SHARES = ", ".join(f"{_SHARE.format(*RULES[r])} AS {r}" for r in RULES)
_CELLS = " UNION ALL ".join(
    f"SELECT lang, quality, '{r}' AS rule, {c} AS cutoff, {r} >= {c} AS hit FROM holdout" for r in RULES for c in CUTOFFS
)

QUALITY_RULES = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents
), split AS (
  SELECT *, {_WORDS.format(text="t")} AS w,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM texts
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM repeated) GROUP BY rid
), measured AS (
  SELECT s.doc_id, s.lang, md5(t) AS tk, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations
  FROM split s LEFT JOIN covered c USING (rid)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_SHARES} FROM measured
), holdout AS (
  SELECT DISTINCT ON (doc_id, lang, tk) j.*, quality
  FROM judged j JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id HAVING min(quality) = max(quality)) USING (doc_id)
  WHERE NOT base_failed
), counts AS (
  SELECT lang, rule, cutoff,
         count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 1 AND hit) AS k_good,
         count(*) FILTER (quality <> 1) AS n_bad, count(*) FILTER (quality <> 1 AND hit) AS k_bad
  FROM ({_CELLS}) GROUP BY ALL
), terms AS (
  SELECT DISTINCT lang, n_good AS n, 0 AS j, n_good * ln({1 - _RISK.risk}) AS term, exp(n_good * ln({1 - _RISK.risk})) AS total
  FROM counts WHERE n_good > 0
  UNION ALL
  SELECT lang, n, j + 1, term + ln((n - j) * {_RISK.risk / (1 - _RISK.risk)} / (j + 1)),
         total + exp(term + ln((n - j) * {_RISK.risk / (1 - _RISK.risk)} / (j + 1)))
  FROM terms WHERE j + 1 <= floor(n * {_RISK.risk})
), limits AS (
  SELECT lang, max(j) AS most FROM terms
  WHERE total <= {_RISK.delta} / ({len(RULES)} * (SELECT count(DISTINCT lang) FROM holdout)) GROUP BY lang
), cutoffs AS (
  SELECT lang, rule, cutoff FROM counts JOIN limits USING (lang)
  WHERE k_good <= most AND n_bad > 0 AND k_bad * n_good > k_good * n_bad
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY k_bad * n_good - k_good * n_bad DESC, cutoff DESC) = 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
         SELECT 1 FROM cutoffs c WHERE c.lang = j.lang AND CASE c.rule {" ".join(f"WHEN '{r}' THEN j.{r}" for r in RULES)} END >= c.cutoff
       ) AS kept, n_lines, n_capitals, n_exclamations
FROM judged j
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS rid, doc_id,
         {_WORDS.format(text=f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT rid, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - 2)) AS i FROM split)
  UNION ALL
  SELECT rid, array_to_string(w, ' ') FROM split WHERE len(w) BETWEEN 1 AND 3
), sizes AS (
  SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), links AS (
  SELECT x.rid AS a, y.rid AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.rid <> y.rid
  JOIN sizes m ON m.rid = x.rid JOIN sizes n ON n.rid = y.rid
  GROUP BY x.rid, y.rid, m.n, n.n HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach AS (
  SELECT rid, rid AS x FROM split
  UNION
  SELECT r.rid, l.b FROM reach r JOIN links l ON l.a = r.x
)
SELECT s.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM split s JOIN reach r ON r.rid = s.rid JOIN split o ON o.rid = r.x LEFT JOIN sizes z ON z.rid = s.rid
GROUP BY s.rid, s.doc_id
"""


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
_LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_STEPS = """SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') || '|' ||
         coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS step
  FROM {0} a JOIN {0} b ON a.tree = b.tree AND a.level = b.level AND a.pos // 16 = b.pos // 16
  WHERE a.size > 1 GROUP BY a.tree, a.level, a.pos"""
_UP = """SELECT tree, level + 1, pos // 16, (size + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos))
  FROM {0} WHERE size > 1 GROUP BY tree, level, pos // 16, size"""

MERKLE_MANIFEST = rf"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS crcs FROM bits WHERE k = 8
), hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS tree, {_LEAF.format(_FIELD.format("text"))} AS leaf,
         {_LEAF.format(_FIELD.format(_LOWERED))} AS changed,
         xor(list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
             lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295) % 5 = 0 AS hit
  FROM documents, crc
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size
  FROM hashed
), nodes AS (
  SELECT tree, 0 AS level, pos, size, leaf AS hash FROM leaves
  UNION ALL
  {_UP.format("nodes")}
), tops AS (
  SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1
), crown AS (
  SELECT '' AS tree, 0 AS level, pos, size, hash FROM tops
  UNION ALL
  {_UP.format("crown")}
), steps AS (
  {_STEPS.format("nodes")}
), crown_steps AS (
  {_STEPS.format("crown")}
), levels AS (
  SELECT l, CAST(pow(16, l) AS BIGINT) AS span FROM range(14) r(l)
), paths AS (
  SELECT rid, list(step ORDER BY above, level) AS path FROM (
    SELECT rid, 0 AS above, level, step FROM leaves v, levels JOIN steps s ON s.tree = v.tree AND s.level = l AND s.pos = v.pos // span
    UNION ALL
    SELECT rid, 1, level, step FROM leaves v JOIN tops t USING (tree), levels JOIN crown_steps s ON s.level = l AND s.pos = t.pos // span
  ) GROUP BY rid
), folded AS (
  SELECT v.doc_id, v.leaf, t.hash AS subroot, c.hash AS root, coalesce(path, []) AS path,
         list_reduce(list_prepend(CASE WHEN hit THEN changed ELSE leaf END, coalesce(path, [])),
                     lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
  FROM leaves v JOIN tops t USING (tree) JOIN crown c ON c.size = 1 LEFT JOIN paths p ON p.rid = v.rid
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""
