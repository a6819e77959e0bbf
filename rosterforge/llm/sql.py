"""DuckDB SQL for the rows of those queries that SQL can express.

Hashes with a seed, tokenizers, models, flows and trees have none; tests hold
those queries against brute force.
"""

from __future__ import annotations

from rosterforge.llm import line_templates as lt

def _gone(i: int, level: lt.Level) -> str:
    """CTEs down to ``gone<i>(doc_id, pos)``: the lines that the level drops."""
    return f"""
leaves{i} AS (SELECT n, head FROM keyed WHERE n BETWEEN {level.least} AND {level.most} GROUP BY ALL HAVING count(DISTINCT same) >= {level.texts}),
found{i} AS (SELECT keyed.* FROM keyed JOIN leaves{i} USING (n, head)),
kinds{i} AS (SELECT n, head, tok, count(DISTINCT same) AS c FROM found{i} GROUP BY ALL),
words{i} AS (SELECT n, head, tok, c, unnest(tok) AS word, generate_subscripts(tok, 1) AS place FROM kinds{i}),
held{i} AS (SELECT n, head, place, word FROM words{i} WHERE word <> '{lt.FIELD}' GROUP BY ALL HAVING sum(c) >= {level.texts}),
slots{i} AS (
  SELECT w.n, w.head, w.tok, any_value(w.c) AS c, list(coalesce(h.word, '{lt.FIELD}') ORDER BY w.place) AS template FROM words{i} w
  LEFT JOIN held{i} h ON h.n = w.n AND h.head = w.head AND h.place = w.place AND h.word = w.word
  GROUP BY w.n, w.head, w.tok HAVING avg(CASE WHEN h.word IS NULL THEN 0 ELSE 1 END) >= {lt.CONSTANT} AND count(h.word) >= {level.fixed}),
often{i} AS (SELECT n, head, template FROM slots{i} GROUP BY ALL HAVING sum(c) >= {level.texts}),
there{i} AS (
  SELECT f.doc_id, f.pos, row_number() OVER (PARTITION BY s.n, s.head, s.template ORDER BY f.doc_id, f.pos) AS nth
  FROM found{i} f JOIN slots{i} s USING (n, head, tok) JOIN often{i} o ON o.n = s.n AND o.head = s.head AND o.template = s.template),
gone{i} AS (SELECT doc_id, pos FROM there{i} WHERE nth > 1)"""


OP7 = f"""
WITH lines AS (
  SELECT doc_id, text AS same, unnest(string_split(even, chr(10))) AS line, generate_subscripts(string_split(even, chr(10)), 1) - 1 AS pos
  FROM (SELECT doc_id, text, regexp_replace(text, '[\\x20\\x09\\x0B-\\x0D]+', ' ', 'g') AS even FROM documents)),
tokens AS (
  SELECT doc_id, same, pos, list_transform(string_split(trim(line, ' '), ' '), lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '{lt.FIELD}' ELSE w END) AS tok
  FROM lines WHERE trim(line, ' ') <> ''),
keyed AS (SELECT *, len(tok) AS n, tok[1:{lt.DEPTH}] AS head FROM tokens),{",".join(_gone(i, x) for i, x in enumerate(lt.LEVELS))},
gone AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM ({" UNION ALL ".join(f"FROM gone{i}" for i in range(len(lt.LEVELS)))}) GROUP BY doc_id)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
  CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines, coalesce(len(gone), 0) AS n_dropped
FROM documents LEFT JOIN gone USING (doc_id)
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP11 = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
low AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
f AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d JOIN low USING (t)),
l AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INTEGER)) AS good, max(CAST(coalesce(toxic = 1, false) AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > low THEN 16 ELSE 0 END AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT i, chr(CAST(65 + i AS INTEGER)) AS name, CAST(1 AS BIGINT) << i AS bit FROM range(5) r(i)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM x a, x b, x c, x d, x e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS BIGINT) AS state FROM orders, range(1, 6) r(step)),
each AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (state | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & state = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN mask & state > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & state = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & state = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM each
"""
