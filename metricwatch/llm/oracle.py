"""DuckDB statements for the corpus queries that SQL can express.

op1, op4 (bin packing), op6 (compression), op7 (learned profiles), op10 (XXH64, reachability) and op12 (HTML) have none;
tests hold them against brute force.
"""

from __future__ import annotations

from metricwatch.llm.lines import BASE, CUTS, MIN_LINES, PRIME
from metricwatch.llm.mixing import BLOCKS, ENTROPY, MAX_REPEAT
from metricwatch.llm.quality import RULES, STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"

URLS = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rhost, rpath, said) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged AS (
  SELECT p.rid, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(said, length(rhost || rpath)) AS said
  FROM (SELECT row_number() OVER () AS rid, * FROM parts) p
  JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY p.rid)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(said, 'allow') AS verdict
FROM (SELECT row_number() OVER () AS rid, * FROM parts) LEFT JOIN judged USING (rid)
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT rid, len(lines) AS n, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
v AS (SELECT *, h % {PRIME} AS v1, (coalesce(lag(h) OVER w, 0) * {BASE} + h) % {PRIME} AS v2 FROM h WINDOW w AS (PARTITION BY rid ORDER BY i)),
cuts AS (SELECT rid, i, win, bit, side FROM v, (VALUES {", ".join(map(str, CUTS))}) b(win, bit), range(2) s(side)
         WHERE (CASE win WHEN 1 THEN v1 ELSE v2 END >> bit) % 2 = side OR i = n),
spans AS (SELECT DISTINCT rid, first, last FROM (
  SELECT rid, coalesce(lag(i) OVER (PARTITION BY rid, win, bit, side ORDER BY i), 1) AS first, i AS last FROM cuts)
  WHERE last - first + 1 >= {MIN_LINES}),
c AS (SELECT rid, doc_id, first, last, array_to_string(lines[first:last], chr(10)) AS chunk FROM spans JOIN d USING (rid)),
r AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id NULLS FIRST, rid, first) > 1 AS later,
        count(*) OVER (PARTITION BY chunk) AS found FROM c WHERE regexp_matches(chunk, '[^\\x20\\x09-\\x0D]')),
gone AS (SELECT rid, i FROM (SELECT rid, later, unnest(range(first, last + 1)) AS i FROM r WHERE found > 1)
         GROUP BY rid, i HAVING bool_and(later)),
t AS (SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (g.rid IS NULL), '') AS text, count(g.rid) AS n_gone
      FROM l LEFT JOIN gone g USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_gone, 0)::INT AS n_gone, CASE WHEN d.text IS NOT NULL THEN length(t.text) END AS n_chars,
       sha256(coalesce(t.text, '')) AS text_sha256
FROM d LEFT JOIN t USING (rid)
"""

EXACT = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

MIXING = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':17'), 1, 7))::BIGINT % {BLOCKS} AS block,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS t FROM documents),
blocks AS (SELECT src, block, sum(t)::BIGINT AS t FROM d GROUP BY ALL),
shares AS (SELECT src, sum(t) AS tokens, sum(t) / sum(sum(t)) OVER () AS p FROM blocks GROUP BY src HAVING sum(t) > 0),
k AS (SELECT count(*) AS k FROM shares),
flat AS (  -- the largest exponent with enough entropy
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 1.0::DOUBLE AS a
  UNION ALL
  SELECT i + 1, CASE WHEN good THEN a ELSE low END, CASE WHEN good THEN high ELSE a END,
         CASE WHEN good THEN (a + high) / 2 ELSE (low + a) / 2 END
  FROM (SELECT i, low, high, a, ln(sum(pow(p, a))) - a * sum(pow(p, a) * ln(p)) / sum(pow(p, a)) >= {ENTROPY} * ln(any_value(k)) - 1e-12 AS good
        FROM flat, shares, k WHERE i < 40 GROUP BY i, low, high, a)),
rare AS (  -- the least exponent that repeats nothing too often
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 0.0::DOUBLE AS a
  UNION ALL
  SELECT i + 1, CASE WHEN much THEN a ELSE low END, CASE WHEN much THEN high ELSE a END,
         CASE WHEN much THEN (a + high) / 2 ELSE (low + a) / 2 END
  FROM (SELECT i, low, high, a, max(pow(p, a - 1)) * max(pow(p, 1 - a)) > {MAX_REPEAT} + 1e-12 AS much
        FROM rare, shares WHERE i < 40 GROUP BY i, low, high, a)),
best AS (SELECT round(greatest((SELECT low FROM flat WHERE i = 40), (SELECT high FROM rare WHERE i = 40)), 6) AS a),
passes AS (SELECT src, tokens, pow(p, a) / sum(pow(p, a)) OVER () AS weight,
                  pow(p, a) * max(tokens / pow(p, a)) OVER () / tokens AS passes FROM shares, best),
plan AS (SELECT src, weight, floor(passes + 1e-9)::INT AS epochs, greatest(passes - floor(passes + 1e-9), 0) * tokens AS rest FROM passes),
used AS (
  SELECT b.src, b.block, weight, epochs + CASE WHEN rest > 1e-6 AND 2 * sum(t) OVER w - t <= 2 * rest THEN 1 ELSE 0 END AS copies
  FROM blocks b JOIN plan USING (src)
  WINDOW w AS (PARTITION BY b.src ORDER BY ('0x' || substr(md5(b.src || ':' || epochs || ':' || b.block), 1, 13))::BIGINT, b.block
               ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT src, block, 0.0, 1 FROM blocks WHERE src NOT IN (SELECT src FROM plan))
SELECT doc_id, source, e::INT AS mix_epoch, block AS mix_block,
       ('0x' || substr(md5(src || ':' || e || ':' || block), 1, 13))::BIGINT AS mix_key, round(weight, 6) AS mix_weight
FROM (SELECT doc_id, source, src, block, weight, unnest(range(copies)) AS e FROM d JOIN used USING (src, block))
"""


def _rules_sql() -> str:
    parts = []
    for r in RULES:
        bounds = [f"{r.metric} >= {r.low}"] * (r.low is not None) + [f"{r.metric} <= {r.high}"] * (r.high is not None)
        parts.append(f"CASE WHEN NOT ({' AND '.join(bounds)}) THEN '{r.name}' END")
    return f"concat_ws(',', {', '.join(parts)})"


QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS w FROM d),
x AS (SELECT rid, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM w),
g AS (SELECT rid, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM x WINDOW o AS (PARTITION BY rid ORDER BY i)),
s AS (SELECT rid, i FROM g WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w, w2, w3) > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM s, range(3) r(j) GROUP BY rid),
ws AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars,
         count(*) FILTER (lower(w) IN ({', '.join(f"'{x}'" for x in STOP_WORDS)})) AS n_stop_words FROM x GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
ls AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (regexp_matches(line, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')) AS n_ellipsis_lines
       FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
f AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines
      FROM d LEFT JOIN rep USING (rid) LEFT JOIN ws USING (rid) LEFT JOIN ls USING (rid)),
m AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_length, coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word,
        coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_word_ratio, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
        coalesce(n_ellipsis_lines / nullif(n_lines, 0), 0) AS ellipsis_line_ratio,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
v AS (SELECT *, {_rules_sql()} AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM v
"""

_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms)) AS total FROM d WHERE len(terms) > 0),
q AS (SELECT iid, item_id, unnest(list_distinct(terms)) AS term FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS terms FROM benchmark)),
t AS MATERIALIZED (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
c AS (SELECT q.iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total)))) AS score
      FROM t JOIN w USING (term) JOIN q USING (term), s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score::BIGINT AS score FROM r WHERE rank <= 10
"""

# crc32 by its public rule: reflected polynomial EDB88320, a byte at a time through a table of 256 numbers
SPELLING = rf"""
WITH RECURSIVE bits(k, v, step) AS (SELECT k, k::BIGINT, 0 FROM range(256) b(k)
  UNION ALL SELECT k, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY k) AS tab FROM bits WHERE step = 8),
runs AS MATERIALIZED (SELECT id, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all({_FOLDED}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
drawn AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, [('0x' || x)::BIGINT FOR x IN regexp_extract_all(
         hex(encode(id || ':' || run)), '..')]), lambda c, b: xor(c >> 8, list_extract(tab, xor(c, b) % 256 + 1)))) AS h FROM runs, crc),
told AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM drawn),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM told WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.i = y.i AND x.word <> y.word
  UNION SELECT v.word, y.word, y.n FROM v JOIN holes y ON v.word = y.a || y.b
  UNION SELECT y.word, v.word, v.n FROM v JOIN holes y ON v.word = y.a || y.b),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS best_n FROM near GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN other END AS form,
         CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n FROM v LEFT JOIN best USING (word)),
ways AS (SELECT word, form AS goal, 1 AS step FROM f WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form, step + 1 FROM ways w JOIN f ON f.word = w.goal WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(goal, step) AS root FROM ways GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM f LEFT JOIN ends USING (word)
"""

SQL = {"op2_url_filters": URLS, "op3_line_dedup": LINES, "op5_exact_dedup": EXACT, "op8_mixing_weights": MIXING,
       "op9_quality_rules": QUALITY, "op11_ranked_lexical_search": LEXICAL, "op13_spelling_variants": SPELLING}
