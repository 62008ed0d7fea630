"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

MIX = """
WITH counted AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weighted AS (SELECT source, n, sqrt(n) AS w FROM counted),
rates AS (SELECT source, (sum(n) OVER ()) / (sum(w) OVER ()) * w / n AS rate FROM weighted),
parts AS (SELECT source, greatest(1, ceil(rate / 64))::BIGINT AS draws, rate / greatest(1, ceil(rate / 64)) AS mean FROM rates),
terms AS (
  SELECT source, unnest(generate_series(0, ceil(mean + 10 * sqrt(mean) + 40)::BIGINT)) AS k, mean FROM parts),
cumulative AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
draws AS (
  SELECT d.doc_id, d.source,
    ('0x' || substr(md5('mix:' || d.doc_id || ':' || i.part), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM documents d JOIN (SELECT source, unnest(generate_series(1, draws)) AS part FROM parts) i
    ON d.source IS NOT DISTINCT FROM i.source),
copies AS (
  SELECT r.doc_id, count(*)::BIGINT AS n FROM draws r JOIN cumulative c
    ON r.source IS NOT DISTINCT FROM c.source AND c.c <= r.u GROUP BY r.doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy
FROM documents d JOIN (SELECT doc_id, unnest(generate_series(1, n)) AS copy FROM copies) c ON d.doc_id = c.doc_id
"""

LINES = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(generate_series(0, len(string_split(coalesce(text, ''), chr(10))) - 1)) AS pos
  FROM documents),
windows AS (
  SELECT doc_id, pos, line AS l0,
    lead(line, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS l1,
    lead(line, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS l2
  FROM lines),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, pos) AS n
  FROM windows WHERE l2 IS NOT NULL AND trim(l0) || trim(l1) || trim(l2) <> ''),
covered AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE n > 1),
kept AS (
  SELECT l.doc_id, l.line, l.pos, c.pos IS NOT NULL AS gone
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos)
SELECT d.doc_id, d.lang, d.source, d.n_chars, k.text, k.n_lines, k.n_removed
FROM documents d JOIN (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
    count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed
  FROM kept GROUP BY doc_id) k ON d.doc_id = k.doc_id
"""

NEAR_DOCUMENTS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.doc_id
"""

NEAR_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON reach.r = links.x),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT l.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN counts c ON l.vec_id = c.vec_id
"""

CODES = """
WITH RECURSIVE kept AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS t(p)),
seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, x FROM parts JOIN seeds USING (r)),
{assign0},
{move0},
{assign1},
{move1},
{assign2},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM own2 GROUP BY r),
digest AS (
  SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN digest
"""


def _codes() -> str:
    steps = {}
    for k in range(3):
        steps[f"assign{k}"] = f"""near{k} AS (
  SELECT a.r, a.p, b.e, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM parts a JOIN book{k} b ON a.p = b.p),
own{k} AS (SELECT r, p, min(d) AS d, arg_min(e, d * 64 + e) AS e FROM near{k} GROUP BY r, p)"""
        steps[f"move{k}"] = f"""sums{k} AS (
  SELECT p, e, pos, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c FROM (
    SELECT o.p, o.e, unnest(a.x) AS c, unnest(range(len(a.x))) AS pos
    FROM own{k} o JOIN parts a ON o.r = a.r AND o.p = a.p) GROUP BY p, e, pos),
book{k + 1} AS (
  SELECT b.p, b.e, coalesce(s.x, b.x) AS x FROM book{k} b
  LEFT JOIN (SELECT p, e, list(c ORDER BY pos) AS x FROM sums{k} GROUP BY p, e) s ON s.p = b.p AND s.e = b.e)"""
    return CODES.format(**steps)


DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (
  SELECT l.lang, coalesce(sum(k.n), 0) AS total, count(k.term) AS v
  FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k USING (lang) GROUP BY l.lang),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v)) AS p,
    (1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v)) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLE_SQL = {
    "op1_mix_sources": MIX,
    "op4_minhash_near_dedup": NEAR_DOCUMENTS,
    "op5_embedding_near_dedup": NEAR_VECTORS,
    "op8_line_dedup": LINES,
    "op12_vector_codes": _codes(),
    "op13_source_divergence": DIVERGENCE,
}
