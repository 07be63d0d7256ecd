"""SQL of the operators over the whole corpus, in the dialect of DuckDB."""

DIVERGENCE = r"""
WITH rows AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), words AS (
    SELECT row_id, lang, source, unnest(terms) AS term FROM rows
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS overall FROM words GROUP BY ALL HAVING count(DISTINCT row_id) >= 30
), counts AS (
    SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), langs AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(overall)::HUGEINT AS total FROM kept GROUP BY lang
), grouped AS (
    SELECT g.lang, g.source, coalesce(l.v, 0)::HUGEINT AS v, coalesce(l.total, 0)::HUGEINT AS lang_total, coalesce(c.total, 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM rows) g LEFT JOIN langs l ON g.lang = l.lang
    LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL) c ON g.lang = c.lang AND g.source = c.source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.total + 5 * g.v) AS p,
           1 + 1000000000::HUGEINT * (k.overall + 5) // (g.lang_total + 5 * g.v) AS q
    FROM grouped g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
    ) d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM found
QUALIFY part = 'pair' OR rank <= 50
"""

COLLOCATIONS = r"""
WITH rows AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM rows
), starts AS (
    SELECT lang, words, unnest(generate_series(1, len(words))) AS i FROM pieces WHERE len(words) > 0
), grams AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, words[i : i + size - 1] AS parts
    FROM starts, (SELECT unnest(generate_series(1, 5)) AS size) WHERE i + size - 1 <= len(words)
), totals AS (
    SELECT lang, count(*)::HUGEINT AS n FROM grams WHERE size = 1 GROUP BY lang
), found AS (
    SELECT lang, size, phrase, any_value(parts) AS parts, count(*)::HUGEINT AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(parts[1 : k], ' ') AS head, array_to_string(parts[k + 1 : size], ' ') AS tail
    FROM found c, (SELECT unnest(generate_series(1, 4)) AS k) WHERE size > 1 AND k < size
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, 1000 * c.a * t.n // (x.f * y.f) AS score
    FROM cuts c JOIN found x ON x.lang = c.lang AND x.phrase = c.head JOIN found y ON y.lang = c.lang AND y.phrase = c.tail JOIN totals t ON t.lang = c.lang
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS (
    SELECT c.lang, array_to_string(parts[i : i + s - 1], ' ') AS phrase, max(f) AS longer
    FROM found c, (SELECT unnest(generate_series(2, 4)) AS s), (SELECT unnest(generate_series(1, 4)) AS i) WHERE s < size AND i + s - 1 <= size GROUP BY ALL
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank, c.phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM scored c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * a
QUALIFY rank <= 2000
"""

JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(list_transform(generate_series(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i : i + 3], ' '))) AS s FROM words WHERE len(w) > 0
), tokens AS (
    SELECT doc_id, unnest(s) AS token FROM sets
), shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS inter FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM shared JOIN sets a ON a.doc_id = u JOIN sets b ON b.doc_id = v WHERE 100 * inter >= 85 * (len(a.s) + len(b.s) - inter)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.v FROM reached r JOIN links l ON l.u = r.other
)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, r.component_id
FROM documents d JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON r.doc_id = d.doc_id LEFT JOIN sets s ON s.doc_id = d.doc_id
"""
