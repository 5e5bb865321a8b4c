"""DuckDB SQL for the queries that SQL can express in reasonable time on whole tables."""

_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": r"""
        WITH a AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM a),
        g AS (SELECT doc_id, i, word,
                     CASE WHEN count(*) OVER f = 20 THEN md5(array_to_string(list(word) OVER f, ' ')) END AS words
              FROM t WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
        l AS (SELECT doc_id, i, word, words IS NOT NULL AND row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1 AS later FROM g),
        c AS (SELECT doc_id, i, word,
                     bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
              FROM l),
        k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
              FROM c GROUP BY doc_id)
        SELECT a.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM a LEFT JOIN k ON a.doc_id = k.doc_id""",
    "op9_exact_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS own, vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, q.own, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
            FROM v q JOIN v ON q.own <> v.own WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS nth FROM s)
        SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM r WHERE nth <= 5""",
    "op13_ranked_search": f"""
        WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
        c AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM d),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS w
              FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
        q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
              GROUP BY item_id, term),
        s AS (SELECT item_id, doc_id,
                     CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length)))) AS BIGINT) AS score
              FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id), c GROUP BY item_id, doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS nth FROM s WHERE score > 0)
        SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM r WHERE nth <= 10""",
}
