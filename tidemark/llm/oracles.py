"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import decontamination

_DECONTAMINATION = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)
),
items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM benchmark)
),
sized AS (SELECT item_id, words, least(len(words), {decontamination.WIDTH}) AS width FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, width, array_to_string(words[i : i + width - 1], ' ') AS win
  FROM (SELECT item_id, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM sized)
),
places AS (
  SELECT doc_id, width, i, array_to_string(words[i : i + width - 1], ' ') AS win
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i
        FROM docs, (SELECT DISTINCT width FROM sized) AS widths WHERE len(words) >= width)
),
found AS (SELECT DISTINCT doc_id, i, width, item_id FROM places JOIN windows USING (width, win)),
hits AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS w FROM found) GROUP BY doc_id
),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

_PREFERENCES = """
WITH last_said AS (
  SELECT conv_id, turn AS last_turn, text AS reply FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC NULLS LAST) = 1
),
marked AS (
  SELECT conv_id, turn, role, text, coalesce(role = 'assistant' AND turn = last_turn, false) AS swapped
  FROM conversations LEFT JOIN last_said USING (conv_id)
),
sided AS (
  SELECT conv_id AS pair_id, 0 AS side, turn, role, text FROM marked
  UNION ALL
  SELECT m.conv_id, 1, turn, role, CASE WHEN swapped THEN reply ELSE text END
  FROM marked m LEFT JOIN last_said n ON n.conv_id = m.conv_id + 1 WHERE NOT swapped OR n.conv_id IS NOT NULL
),
numbered AS (
  SELECT pair_id, side, coalesce(role, 'unknown') AS role, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM sided
),
drawn AS (
  SELECT *, '<|' || role || '|>' || chr(10) AS head, body || '<|end|>' || chr(10) AS tail FROM numbered
),
sides AS (SELECT pair_id, side, max(n) AS turns FROM drawn GROUP BY ALL),
whole AS (
  SELECT pair_id, coalesce(max(turns) FILTER (side = 0), 0) AS a, coalesce(max(turns) FILTER (side = 1), 0) AS b FROM sides GROUP BY pair_id
),
first_other AS (
  SELECT x.pair_id, min(x.n) AS n FROM drawn x JOIN drawn y ON x.pair_id = y.pair_id AND x.n = y.n AND x.side = 0 AND y.side = 1
  WHERE x.role <> y.role OR x.body <> y.body GROUP BY x.pair_id
),
cut AS (SELECT pair_id, coalesce(n - 1, least(a, b)) AS n_common FROM whole LEFT JOIN first_other USING (pair_id)),
laid AS (
  SELECT pair_id, side, n, role, head || tail AS turn, n_common, n > n_common AS rest,
         sum(CASE WHEN n > n_common THEN length(head) + length(tail) ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY n) AS stop, length(tail) AS width
  FROM drawn JOIN cut USING (pair_id)
)
SELECT pair_id, any_value(n_common) AS n_common,
  coalesce(string_agg(turn, '' ORDER BY n) FILTER (side = 0 AND NOT rest), '') AS prompt,
  coalesce(string_agg(turn, '' ORDER BY n) FILTER (side = 0 AND rest), '') AS chosen,
  coalesce(string_agg(turn, '' ORDER BY n) FILTER (side = 1 AND rest), '') AS rejected,
  coalesce(string_agg((stop - width)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY n) FILTER (side = 0 AND rest AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((stop - width)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY n) FILTER (side = 1 AND rest AND role = 'assistant'), '') AS rejected_mask
FROM laid GROUP BY pair_id
"""

_PHRASES = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM texts),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size)),
runs AS (SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS uses FROM starts GROUP BY ALL HAVING count(*) >= 30),
phrases AS (SELECT lang, size, phrase, uses AS a, string_split(phrase, ' ') AS words FROM runs WHERE size > 1),
cuts AS (
  SELECT lang, size, phrase, words, a, k, array_to_string(words[1 : k], ' ') AS head, array_to_string(words[k + 1 : size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM phrases)
),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.words, c.a, h.uses AS l, t.uses AS r, k, ((2000000::HUGEINT * c.a) // (h.uses + t.uses))::BIGINT AS score
  FROM cuts c JOIN runs h ON h.lang = c.lang AND h.phrase = c.head JOIN runs t ON t.lang = c.lang AND t.phrase = c.rest
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (
  SELECT lang, a, array_to_string(words[i : i + width - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - width + 2)) AS i FROM phrases JOIN (SELECT unnest([2, 3]) AS width) ON width < size)
),
around AS (SELECT lang, phrase, max(a) AS a FROM inner_runs GROUP BY ALL),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN around USING (lang, phrase) WHERE around.a IS NULL OR 100 * around.a < 80 * lowest.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op2_preferences": _PREFERENCES, "op8_decontamination": _DECONTAMINATION, "op11_phrases": _PHRASES}
