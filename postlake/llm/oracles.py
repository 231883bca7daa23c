"""DuckDB SQL of the operators that SQL can express, over the same tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALPHANUMERIC = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BETWEEN_SPACES = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_ALPHANUMERIC} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALPHANUMERIC} AS w FROM benchmark),
p AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
),
windows AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d JOIN (SELECT DISTINCT n FROM p) ON len(w) >= n
    )
),
hits AS (SELECT doc_id, i, p.n, item FROM windows JOIN p USING (phrase)),
words AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_BETWEEN_SPACES} AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON a = d.doc_id
"""

WARC = """
WITH p AS (
    SELECT page_id, coalesce(url, '') AS url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
),
o AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, url, payload_bytes, payload_digest,
    CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id > first_id THEN first_id END AS refers_to, payload_digest AS told_digest
FROM p LEFT JOIN o USING (payload_digest)
"""

# CRC-32 of distinct words, a byte at a time over the usual table of 256 entries
RESAMPLING = f"""
WITH t AS (
    SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS crc
    FROM (SELECT unnest(range(256)) AS n)
),
d AS (SELECT doc_id, {_ALPHANUMERIC} AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
bw AS (SELECT unnest({_ALPHANUMERIC}) AS word FROM benchmark),
v AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
b AS (
    SELECT word, list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT)) AS bytes
    FROM (SELECT word, hex(encode(word)) AS h FROM v)
),
k AS (
    SELECT word, xor(list_reduce(bytes, lambda c, x: xor(crc[xor(c & 255, x) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
    FROM b, t
),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN k USING (word) GROUP BY bucket),
g AS (SELECT bucket, count(*) AS n FROM bw JOIN k USING (word) GROUP BY bucket),
totals AS (
    SELECT (SELECT count(*) FROM dw)::DOUBLE AS s_all, (SELECT count(*) FROM bw)::DOUBLE AS t_all
),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln(((coalesce(g.n, 0) + 1)::DOUBLE * (s_all + 10000)) / ((s.n + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
    FROM s LEFT JOIN g USING (bucket), totals
),
weights AS (SELECT doc_id, sum(gain) AS weight FROM dw JOIN k USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM d LEFT JOIN weights USING (doc_id)
),
drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT doc_id, CAST(rank AS BIGINT) AS rank FROM drawn WHERE rank <= 10 * n // 100) USING (doc_id)
"""

_VECTORS = """
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

TOP_K = f"""
WITH v AS ({_VECTORS}),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

HARD_NEGATIVES = f"""
WITH v AS (
    SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM ({_VECTORS}) WHERE label IS NOT NULL
),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5
"""
