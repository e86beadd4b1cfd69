"""SQL for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce({WORDS.format("text")}, []) AS w FROM documents),
item AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS phrase
    FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
phrases AS (SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS phrase
    FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d), sizes WHERE i + n <= len(w)),
hits AS MATERIALIZED (SELECT doc_id, i, n, item FROM phrases JOIN windows USING (n, phrase)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: The words of the texts paired with their equals up to a fourth of the text further on; islands of one distance are runs.
RUNS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
    xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1))), 4294967295) AS h FROM documents),
e AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS dealt, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a,
    3 + (h // 10) % 8 AS parts FROM d),
tok AS MATERIALIZED (SELECT r, i, n, w[1 + CASE WHEN dealt AND i >= a THEN a + (i - a) % (1 + (n - a) // parts) ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM e)),
same AS (SELECT x.r, x.i, y.i - x.i AS q FROM tok x JOIN tok y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (SELECT r, q, min(i) AS s, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same)
    GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
run AS MATERIALIZED (SELECT r, s, length, min(q) AS q FROM island GROUP BY r, s, length),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + length)) AS i FROM run),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM tok ANTI JOIN gone USING (r, i) GROUP BY r),
listed AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    arg_max((s, length, q), (length, -s, -q)) AS best FROM run GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
    1000 * best[2] // best[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""

TERMS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS.format("text")} AS w FROM documents),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
item AS (SELECT q, item_id, term, count(*) AS n FROM (SELECT row_number() OVER () AS q, item_id, unnest({TERMS.format("text")}) AS term FROM benchmark) GROUP BY ALL),
mass AS (SELECT r, doc_id, 100 - 25 + (25 * len(w) * n_docs) // n_terms AS m FROM d, corpus WHERE len(w) > 0),
score AS (SELECT q, item_id, r, doc_id, CAST(sum(n * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN mass USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 20
"""
TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": DECONTAMINATION, "op11_runs": RUNS, "op12_search": SEARCH, "op13_topk": TOP_K}
