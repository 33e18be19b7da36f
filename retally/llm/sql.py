"""The same results in DuckDB's SQL, by plain means."""

from retally.llm.blob_ledger import BASE, RULES

_COMPONENTS = """
either_way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reached AS (
  SELECT DISTINCT a AS id, a AS other FROM either_way
  UNION
  SELECT r.id, e.b FROM reached r JOIN either_way e ON r.other = e.a
),
least AS (SELECT id, min(other) AS component FROM reached GROUP BY id)
"""

MINHASH = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM words
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
),
link AS (
  SELECT c.a, c.b FROM common c JOIN size p ON c.a = p.doc_id JOIN size q ON c.b = q.doc_id
  WHERE 100 * both_have >= 85 * (p.n + q.n - both_have)
),
{_COMPONENTS}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM documents d LEFT JOIN size s USING (doc_id) LEFT JOIN least l ON d.doc_id = l.id
"""

LATTICE = f"""
WITH RECURSIVE unit AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
),
norm AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM unit),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM norm x JOIN norm y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE x.n > 0 AND y.n > 0 AND list_dot_product(x.v, y.v) / (x.n * y.n) >= 0.98
),
{_COMPONENTS},
degree AS (SELECT a, count(*) AS n FROM either_way GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, coalesce(l.component, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least l ON e.vec_id = l.id
"""

WARC = """
WITH coded AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS code FROM pages
),
digits AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(code, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest
  FROM coded
),
last AS (SELECT payload_digest, max(page_id) AS last FROM digits GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM digits JOIN last USING (payload_digest)
"""

_WHOLE = """
fine AS (
  SELECT * FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)
"""

TOP_SCORES = f"""
WITH {_WHOLE},
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM fine),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
WHERE rank <= 20
"""

NEGATIVES = f"""
WITH {_WHOLE},
v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM fine WHERE label IS NOT NULL
),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

STRIPES = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
hit AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
known AS (SELECT lang, term, count(*) AS n FROM hit GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
cell AS (SELECT h.lang, h.source, h.term, count(*) AS n FROM hit h JOIN known k ON h.lang = k.lang AND h.term = k.term GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v, sum(n) AS n FROM known GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
size AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM grp g LEFT JOIN cell c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (s.n + 5 * v.v)::HUGEINT)::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.n + 5) // (v.n + 5 * v.v)::HUGEINT)::BIGINT AS q
  FROM size s JOIN vocabulary v ON s.lang = v.lang JOIN known k ON k.lang = s.lang
  LEFT JOIN cell c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
told AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM told QUALIFY part = 'pair' OR rank <= 50
"""


def secrets() -> str:
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    parts = []
    for place, rule in enumerate(RULES):
        pattern = quoted(rule.pattern)
        parts.append(f"""
  SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, unnest(range(1, len(m) + 1)) AS i, m, g, p FROM (
    SELECT doc_id, regexp_extract_all(t, {pattern}) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS g,
           string_split_regex(t, {pattern}) AS p FROM texts)
  """)
    least = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in RULES)
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    zero = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT doc_id, kind, place, length(m[i]) AS size, length(g[i]) AS inner_size,
         list_sum(list_transform(p[1:i], lambda x: length(x)))::BIGINT
         + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start FROM found
),
good AS (
  SELECT *, kind || ':' || start || ':' || (start + size) AS span FROM placed
  WHERE inner_size >= CASE kind {least} END
),
told AS (
  SELECT doc_id, {counts},
         string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ({base})) AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans FROM good GROUP BY doc_id
)
SELECT d.doc_id, {zero}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told USING (doc_id)
"""
