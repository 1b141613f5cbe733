"""The queries that SQL can express, for DuckDB. The others are held against plain versions in the tests.

Components come from the transitive closure of the links, which is fit for small tables only.
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+')"

_REACHED = """
    reach(id, other) AS (SELECT a, b FROM pairs UNION SELECT r.id, p.b FROM reach r JOIN pairs p ON r.other = p.a),
    least_reached AS (SELECT id, min(other) AS low FROM reach GROUP BY id),
    direct AS (SELECT a AS id, count(*) AS n FROM pairs GROUP BY a)"""


def ngram_join(words: int, percent: int) -> str:
    return f"""
        WITH RECURSIVE split AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE text IS NOT NULL),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + {words - 1}], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words} + 1, least(len(w), 1)) + 1)) AS i FROM split)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s
                   AND x.doc_id <> y.doc_id GROUP BY ALL),
        pairs AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                  WHERE 100 * shared.n >= {percent} * (x.n + y.n - shared.n)),
        {_REACHED}
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id,
               coalesce(l.n, 0) AS n_links
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_reached r ON r.id = d.doc_id
        LEFT JOIN direct l ON l.id = d.doc_id"""


VECTOR_JOIN = f"""
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
        ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
        WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.98),
    {_REACHED}
    SELECT v.vec_id, coalesce(l.n, 0) AS n_links, least(v.vec_id, coalesce(r.low, v.vec_id)) AS component_id,
           coalesce(r.low, v.vec_id) >= v.vec_id AS kept
    FROM embeddings v LEFT JOIN least_reached r ON r.id = v.vec_id LEFT JOIN direct l ON l.id = v.vec_id"""

STUPID_BACKOFF = f"""
    WITH split AS (SELECT doc_id, {WORDS} AS words FROM documents),
    placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS w, unnest(range(len(words))) AS i FROM split),
    before AS (SELECT *, lag(w) OVER text AS v, lag(w, 2) OVER text AS u FROM placed
               WINDOW text AS (PARTITION BY doc_id ORDER BY i)),
    outside AS (
        SELECT doc_id, n, i, count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY doc_id, w) AS n1,
               count(*) OVER (PARTITION BY v, w) - count(*) OVER (PARTITION BY doc_id, v, w) AS n2,
               count(*) OVER (PARTITION BY u, v, w) - count(*) OVER (PARTITION BY doc_id, u, v, w) AS n3 FROM before),
    contexts AS (SELECT *, lag(n1) OVER text AS c1, lag(n2) OVER text AS c2 FROM outside
                 WINDOW text AS (PARTITION BY doc_id ORDER BY i)),
    scored AS (
        SELECT doc_id, CASE WHEN i > 1 AND n3 > 0 THEN ln(n3 / c2)
                            WHEN i > 0 AND n2 > 0 THEN ln(0.4 ** least(i - 1, 1) * n2 / c1)
                            ELSE ln(0.4 ** least(i, 2) * greatest(n1, 0.5) / greatest((SELECT count(*) FROM placed) - n, 1)) END AS s
        FROM contexts),
    summed AS (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id)
    SELECT doc_id, coalesce(len(words), 0) AS n_words, round(coalesce(s, 0), 4) AS log_score,
           CASE WHEN len(words) > 0 THEN round(s / len(words), 4) END AS mean_log_score
    FROM split LEFT JOIN summed USING (doc_id)"""

SOURCE_DIVERGENCE = """
    WITH given AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
    placed AS (SELECT lang, source, id, unnest(terms) AS term FROM given),
    kept AS (SELECT lang, term, count(*) AS n_lang FROM placed GROUP BY ALL HAVING count(DISTINCT id) >= 10),
    langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS n FROM kept GROUP BY lang),
    own AS (SELECT lang, source, term, count(*) AS n FROM placed JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM given),
    totals AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM groups LEFT JOIN own USING (lang, source) GROUP BY ALL),
    shares AS (
        SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS own_n,
               1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 2) // (t.n + 2 * l.v) AS p,
               1 + 1000000000::HUGEINT * (k.n_lang + 2) // (l.n + 2 * l.v) AS q
        FROM groups g JOIN kept k USING (lang) JOIN totals t ON t.lang = g.lang AND t.source = g.source JOIN langs l ON l.lang = g.lang
        LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
    pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
               coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
        LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
    listed AS (
        SELECT * FROM pairs UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE own_n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 10"""

ORACLES = {
    "op5_ngram_join": ngram_join(4, 85),
    "op8_subspace_join": VECTOR_JOIN,
    "op10_stupid_backoff": STUPID_BACKOFF,
    "op12_source_divergence": SOURCE_DIVERGENCE,
}
