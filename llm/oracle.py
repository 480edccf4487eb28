"""DuckDB SQL of the queries that SQL can express and run over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_WORDS = r"[^\x20\x09-\x0D]+"


def _words(text: str, pattern: str, lower: bool) -> str:
    text = f"coalesce({text}, '')"
    return f"regexp_extract_all({f"translate({text}, '{UPPER}', '{LOWER}')" if lower else text}, '{pattern}')"


DECONTAMINATION = f"""
    WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_words('text', ALNUM_WORDS, True)} AS w FROM benchmark),
    phrases AS (SELECT DISTINCT item, k, array_to_string(w[s : s + k - 1], ' ') AS phrase
                FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
    d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', ALNUM_WORDS, True)} AS w FROM documents),
    spans AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d JOIN (SELECT DISTINCT k FROM phrases) ON len(w) >= k),
    hits AS (SELECT r, s, phrases.k, item FROM (SELECT r, s, k, array_to_string(w[s : s + k - 1], ' ') AS phrase FROM spans) JOIN phrases USING (k, phrase)),
    hit AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
    items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""

NGRAM_JACCARD = f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', PLAIN_WORDS, True)} AS w FROM documents),
    s AS (SELECT DISTINCT r, array_to_string(w[p : p + k - 1], ' ') AS g
          FROM (SELECT r, w, least(len(w), 3) AS k, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS p FROM d WHERE len(w) > 0)),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    shared AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
    links AS (SELECT x, y FROM shared JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * common >= 90 * (a.n + b.n - common)),
    reach AS (SELECT DISTINCT x, x AS y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
    low AS (SELECT reach.x AS r, min(doc_id) AS c FROM reach JOIN d ON d.r = reach.y GROUP BY 1)
    SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id
    FROM d LEFT JOIN n USING (r) LEFT JOIN low USING (r)"""

TOPK_SEARCH = """
    WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 10"""

LINE_DEDUP = f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, line_no, {_words('ls[line_no + 1]', PLAIN_WORDS, False)} AS w
          FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS line_no FROM d)),
    o AS (SELECT doc_id, line_no, w, array_to_string(w, ' ') AS line, row_number() OVER (ORDER BY doc_id, line_no) AS p FROM l WHERE len(w) > 0),
    u AS (SELECT line, w, min(p) AS p FROM o GROUP BY 1, 2),
    c AS (SELECT line, p, j, array_to_string(list_concat(w[1 : j - 1], w[j + 1 : len(w)]), ' ') AS v
          FROM (SELECT line, p, w, unnest(range(1, len(w) + 1)) AS j FROM u WHERE len(w) >= 8)),
    rep AS (SELECT v, j, min(p) AS p FROM c GROUP BY 1, 2),
    pairs AS (SELECT c.p AS a, u.p AS b FROM c JOIN u ON u.line = c.v AND len(u.w) >= 8),
    near AS (SELECT c.p FROM c JOIN rep USING (v, j) WHERE rep.p < c.p UNION SELECT greatest(a, b) FROM pairs),
    gone AS (SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS removed
             FROM o WHERE p NOT IN (SELECT p FROM u) OR p IN (SELECT p FROM near) GROUP BY 1)
    SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
    FROM d LEFT JOIN gone USING (doc_id)"""

SUBSTRING_DEDUP = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', PLAIN_WORDS, False)} AS w FROM documents),
    s AS (SELECT r, p, sha256(array_to_string(w[p : p + 34], ' ')) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
    rep AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
    gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM s JOIN rep USING (g)),
    word AS (SELECT r, w[q] AS x, q FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS q FROM d)),
    kept AS (SELECT r, string_agg(x, ' ' ORDER BY q) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, q) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": DECONTAMINATION,
        "op4_ngram_jaccard": NGRAM_JACCARD,
        "op5_topk_search": TOPK_SEARCH,
        "op8_line_dedup": LINE_DEDUP,
        "op10_substring_dedup": SUBSTRING_DEDUP,
    }
