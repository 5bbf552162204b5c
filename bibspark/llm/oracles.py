"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from . import quality_rules as rules
from . import spelling

#: crc32 of bytes, a table step a byte: ``tbl`` is the table of the 256 steps.
CRC_TABLE = """crc AS (SELECT list(step ORDER BY i) AS tbl FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step
    FROM range(256) r(i)))"""


def crc32(text: str) -> str:
    """The crc32 of the UTF-8 bytes of a text; ``tbl`` of ``crc`` must be in scope."""
    byte = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {byte}, lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295)"


WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH {CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS said FROM documents),
split AS (SELECT r, doc_id, said, regexp_extract_all(said, '{WORD}') AS words FROM docs),
spelt AS (SELECT w, {crc32("w")} AS h FROM (SELECT DISTINCT unnest(words) AS w FROM split), crc),
words AS (SELECT r, i, w FROM (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split)),
hashed AS (SELECT r, i, h, lead(h) OVER (PARTITION BY r ORDER BY i) AS h2 FROM words JOIN spelt USING (w)),
grams AS (SELECT r, h % {rules.BUCKETS} AS bucket FROM hashed
          UNION ALL SELECT r, ((h * {rules.PAIR} + h2) >> 14) % {rules.BUCKETS} FROM hashed WHERE h2 IS NOT NULL),
trusted AS (SELECT r FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
counts AS (SELECT bucket, count(*) AS n, count(*) FILTER (WHERE r IN (FROM trusted)) AS t FROM grams GROUP BY bucket),
shares AS (SELECT bucket, n, t, sum(n) OVER () AS all_n, sum(t) OVER () AS all_t, (n + 1) / (sum(n) OVER () + {rules.BUCKETS}) AS p FROM counts),
ratios AS (SELECT bucket, round(ln({rules.MIX} * ((t + {rules.BUCKETS} * p) / (all_t + {rules.BUCKETS})) / p + (1 - {rules.MIX})) * {rules.UNIT})::BIGINT AS ratio FROM shares),
scores AS (SELECT r, sum(ratio) AS total, count(*) AS n_grams FROM grams JOIN ratios USING (bucket) GROUP BY r),
windows AS (SELECT r, i, array_to_string(list_slice(words, i, i + {rules.WINDOW - 1}), ' ') AS win
            FROM (SELECT r, words, unnest(range(1, len(words) - {rules.WINDOW - 2})) AS i FROM split)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + {rules.WINDOW})) AS place FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(said, chr(10))) AS line FROM docs)
          WHERE regexp_matches(line, '{rules.WORD_CHAR}') GROUP BY r),
measured AS (
    SELECT r, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           (length(said) - length(regexp_replace(said, '{rules.SYMBOL}', '', 'g')))::BIGINT AS n_symbols,
           coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured LEFT JOIN scores USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND total >= n_grams * {int(round(rules.LEAST * rules.UNIT))} AS kept
FROM judged
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '{spelling.LETTERS}{{{spelling.SHORTEST},}}')), '{spelling.UPPER}', '{spelling.LOWER}') AS run FROM documents),
hashed AS (SELECT run, times, {crc32("said")} AS h FROM (
    SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS said, count(*) AS times FROM runs GROUP BY ALL), crc),
words AS (SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % {spelling.SLIP} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(times) >= {spelling.SELDOM}),
cuts AS (SELECT DISTINCT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT a AS word, count(*) AS n_near, min(row(-n, b)) AS top FROM pairs JOIN words ON b = word GROUP BY a),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                 CASE WHEN -top[1] >= {spelling.FACTOR} * w.n THEN top[2] END AS form, CASE WHEN -top[1] >= {spelling.FACTOR} * w.n THEN -top[1] END AS form_n
          FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM forms
         UNION ALL SELECT walk.word, walk.next, f.form FROM walk JOIN forms f ON walk.next = f.word)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n FROM forms f JOIN walk ON walk.word = f.word AND walk.next IS NULL
"""

ORACLES = {"op11_quality_rules": QUALITY_RULES, "op12_spelling_variants": SPELLING_VARIANTS}
