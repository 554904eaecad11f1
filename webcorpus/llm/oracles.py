"""DuckDB SQL for the queries of this subpackage, where SQL can state them."""

from webcorpus.llm.license_scan import TEMPLATES

OP2 = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
   WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0),
 u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM v
   WHERE list_sum(list_transform(e, lambda y: y * y)) > 0),
 link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.93),
 reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
 n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, m AS component_id, vec_id = m AS kept
FROM embeddings JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

OP1 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s
         FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
 least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
 hit AS (SELECT doc_id, i FROM win JOIN least USING (s) WHERE doc_id > m),
 gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit),
 word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM w),
 kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
 n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP10 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
 win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
         FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
 least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
 hit AS (SELECT doc_id, i FROM win JOIN least USING (s) WHERE doc_id > m),
 start AS (SELECT doc_id, i, CASE WHEN i <= 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS f FROM hit),
 span AS (SELECT doc_id, i, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM start),
 spans AS (SELECT doc_id, g, min(i) AS a, max(i) + 50 AS b FROM span GROUP BY doc_id, g),
 gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM spans
          UNION ALL SELECT doc_id, max(b), 2000000000 FROM spans GROUP BY doc_id),
 kept AS (SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
 n AS (SELECT doc_id, sum(b - a) AS n, count(*) AS c FROM spans GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(c, 0)::BIGINT AS n_spans,
 sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP3 = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
   md5(coalesce(text, '')) AS tie FROM documents),
 q AS (SELECT doc_id, max(CASE WHEN quality > 0 THEN 2.0::DOUBLE WHEN quality IS NOT NULL THEN 0.5::DOUBLE END) AS w FROM labels GROUP BY doc_id),
 s AS (SELECT source, source_size, [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight
       FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
 r AS (SELECT *, 2.0 * source_size / weight AS ratio FROM s),
 -- The level at which the sources with the k smallest ratios are full: the first one that does not fill the next.
 c AS (SELECT a.ratio, (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(2.0 * b.source_size) FILTER (b.ratio < a.ratio), 0))
         / sum(b.weight) FILTER (b.ratio >= a.ratio) AS level FROM r a, r b GROUP BY a.ratio),
 l AS (SELECT level FROM c WHERE level <= ratio ORDER BY ratio LIMIT 1),
 t AS (SELECT source, source_size, least(2.0 * source_size, level * weight)::DOUBLE AS target FROM r, l),
 k AS (SELECT d.*, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0) / coalesce(w, 1.0) AS key
       FROM d LEFT JOIN q USING (doc_id)),
 p AS (SELECT k.doc_id, size, source_size, target, coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, tie
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
 (floor(target / source_size) * size + greatest(0, least(size, floor(target) - floor(target / source_size) * source_size - before)))::BIGINT AS taken
FROM p
"""

OP5 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM d WHERE len(ws) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id
          JOIN n y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
 reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.m AS component_id, d.doc_id = c.m AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source,
   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
 win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
 twice AS (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1),
 cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM win JOIN twice USING (doc_id, s)) GROUP BY doc_id),
 line AS (SELECT doc_id, source, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS n,
    len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS words FROM (SELECT doc_id, source, unnest(ls) AS l FROM d)),
 host AS (SELECT source, count(DISTINCT doc_id) AS docs FROM d GROUP BY source),
 freq AS (SELECT source, n FROM line JOIN host USING (source) GROUP BY source, n, docs HAVING count(DISTINCT doc_id) > greatest(20, 2 * sqrt(docs))),
 lost AS (SELECT doc_id, sum(words) AS lost FROM line JOIN freq USING (source, n) GROUP BY doc_id),
 m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN cov USING (doc_id)),
 b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT b.*, NOT base_failed AND n_words - coalesce(lost, 0) >= 0.5 * n_words AS kept FROM b LEFT JOIN lost USING (doc_id)
"""

def op7() -> str:
    quoted = ", ".join("({}, '{}', {}, '{}')".format(i, n, r, t.replace("'", "''")) for i, (n, r, t) in enumerate(TEMPLATES))
    grams = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return f"""
WITH t0(k, name, restricted, t) AS (VALUES {quoted}),
 t1 AS (SELECT k, name, restricted, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM t0),
 t AS (SELECT k, name, restricted, {grams.format("w")} AS g FROM t1),
 p0 AS (SELECT doc_id, unnest(list_append(string_split(text, chr(10)), text)) AS p FROM documents WHERE text IS NOT NULL),
 p1 AS (SELECT doc_id, regexp_extract_all(lower(p), '[a-z0-9]+') AS w FROM p0),
 p AS (SELECT DISTINCT doc_id, list_sort({grams.format("w")}) AS g FROM p1 WHERE len(w) BETWEEN 2 AND 2000),
 m AS (SELECT doc_id, p.g, name, restricted, 2.0::DOUBLE * len(list_intersect(p.g, t.g)) / (len(p.g) + len(t.g)) AS d FROM p, t
       WHERE len(p.g) <= 1.5 * len(t.g) AND len(t.g) <= 1.5 * len(p.g)),
 b AS (SELECT doc_id, min((-d, name, restricted)) AS best, count(DISTINCT g)::BIGINT AS n FROM m WHERE d >= 0.8 GROUP BY doc_id)
SELECT doc_id, best[2] AS license, coalesce(best[3], false) AS restricted, round(coalesce(-best[1], 0.0), 6)::DOUBLE AS dice,
 coalesce(n, 0)::BIGINT AS n_passages FROM documents LEFT JOIN b USING (doc_id)
"""


OP11 = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
     AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
   WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 10
"""

OP12 = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
 r AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
   FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
   WHERE length(run) >= 7 GROUP BY ALL),
 x AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM r),
 h AS (SELECT run, c, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
   lambda k, b: xor(k >> 8, t[(xor(k, b) & 255) + 1]))) AS h FROM x, t),
 w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
   FROM h GROUP BY 1 HAVING length(word) >= 7 AND sum(c) >= 2),
 less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
 near AS (SELECT a.word, b.word AS form, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
   UNION SELECT a.word, b.word, b.n FROM less a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM less a JOIN w b ON a.rest = b.word),
 best AS (SELECT word, count(*) AS n_near, min((-n, form)) AS b FROM near GROUP BY word),
 f AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b[1] >= 10 * n THEN b[2] END AS form, CASE WHEN -b[1] >= 10 * n THEN -b[1] END::BIGINT AS form_n
   FROM w LEFT JOIN best USING (word)),
 walk(word, root) AS (SELECT word, word FROM w UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM f JOIN walk USING (word) JOIN f g ON g.word = walk.root WHERE g.form IS NULL
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
 w AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
 k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
 c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
 v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
 g AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
 p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v.v) AS p,
     1 + (1000000000::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v) AS q
   FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
 s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term)
   WHERE a.source <> b.source GROUP BY ALL),
 pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
 terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""


ORACLES = {
    "op1_substring_dedup": OP1,
    "op2_embedding_dedup": OP2,
    "op3_mixing": OP3,
    "op5_near_dedup": OP5,
    "op6_quality_rules": OP6,
    "op7_license_scan": op7(),
    "op10_suffix_dedup": OP10,
    "op11_topk_search": OP11,
    "op12_spelling_variants": OP12,
    "op13_source_divergence": OP13,
}
