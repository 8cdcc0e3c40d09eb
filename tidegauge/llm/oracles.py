"""SQL counterparts of the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from tidegauge.llm.common import LOWER, UPPER

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


def grams(n: str) -> str:
    """The runs of ``n`` words of the list ``w``, as a list of texts."""
    return f"list_transform(generate_series(1, len(w) - {n} + 1), lambda i: array_to_string(list_slice(w, i, i + {n} - 1), ' '))"


#: From links (x, y) in both directions: the smallest id that each x reaches.
REACHED = """
    reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
    top AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

ORACLES: dict[str, str] = {
    "op1_decontaminate": f"""
    WITH d AS (SELECT doc_id, {words(ALNUM)} AS w FROM documents),
         b AS (SELECT item_id, {words(ALNUM)} AS w FROM benchmark),
         cut AS (SELECT item_id, least(len(w), 13) AS n, w FROM b WHERE len(w) > 0),
         windows AS (SELECT DISTINCT item_id, n, phrase FROM (SELECT item_id, n, unnest({grams("n")}) AS phrase FROM cut)),
         sizes AS (SELECT DISTINCT n FROM windows),
         runs AS (SELECT doc_id, n, unnest({grams("n")}) AS phrase, unnest(generate_series(1, len(w) - n + 1)) AS spot
                  FROM d JOIN sizes ON len(w) >= n),
         hits AS (SELECT doc_id, spot, n, item_id FROM runs JOIN windows USING (n, phrase)),
         hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                 FROM (SELECT doc_id, unnest(generate_series(spot, spot + n - 1)) AS p FROM hits) GROUP BY doc_id),
         item AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS digest
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(digest, sha256('')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)""",
    "op4_embeddings": f"""
    WITH RECURSIVE v AS (
             SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
             WHERE label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
         link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
         degree AS (SELECT x, count(*) AS n FROM link GROUP BY x), {REACHED}
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, top.y), vec_id) AS component_id,
           coalesce(least(vec_id, top.y), vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN degree ON degree.x = vec_id LEFT JOIN top ON top.x = vec_id""",
    "op10_ngram_join": f"""
    WITH RECURSIVE d AS (SELECT doc_id, {words(SPACED)} AS w FROM documents),
         sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                      ELSE list_distinct({grams("3")}) END AS s FROM d),
         gram AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
         pair AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, count(*) AS common
                  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2, 3),
         link AS (SELECT x, y FROM pair WHERE 100 * common >= 90 * (total - common)), {REACHED}
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(least(doc_id, top.y), doc_id) AS component_id
    FROM sets LEFT JOIN top ON top.x = doc_id""",
    "op13_hard_negatives": """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         scored AS (SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
                           CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
                    FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
         positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
                      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
           score AS negative_score
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 5""",
}
