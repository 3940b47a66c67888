"""The same results in SQL, for the operators that it can express."""

NEGATIVES = """
WITH given AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM given),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other_id, b.label AS other_label,
           CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE other_label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND n.other_label <> n.anchor_label
 AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           CAST('0x' || substr(md5(concat_ws(chr(10), CAST(doc_id AS VARCHAR), text)), 1, 15) AS BIGINT) AS h FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight FROM sized GROUP BY source),
stops AS (
    SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source) AS n,
           (SELECT sum(source_size) FROM sources) AS total FROM sources),
levels AS (
    SELECT n, (total - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level, 3 * source_size AS stop, weight
    FROM stops WINDOW before AS (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- the level at which the first source that has not stopped stays below its stop
level AS (SELECT level FROM levels WHERE stop > level * weight ORDER BY n LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN 3 * source_size <= coalesce(level, 0) * weight THEN 3.0::DOUBLE * source_size
                                     ELSE coalesce(level, 0) * weight END AS target FROM sources LEFT JOIN level ON true),
needs AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
hashes AS (
    SELECT source, h, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(size) AS before
    FROM sized GROUP BY source, h)
SELECT d.doc_id, d.size, n.source_size, n.target,
       CAST(d.size * (n.whole + CASE WHEN e.before < n.target - n.whole * n.source_size
                                      AND 2 * (n.target - n.whole * n.source_size - e.before) >= e.words THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source
JOIN hashes e ON d.source IS NOT DISTINCT FROM e.source AND d.h = e.h
"""

# a long that may be null is a double in pandas, on both sides
PREFIXES = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)) AS bytes
    FROM turns GROUP BY conv_id),
-- CRC-32, bit by bit
heads AS (
    SELECT conv_id, n, base, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
        list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, zero: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 4 AS h
    FROM sizes),
rebuilt AS (
    SELECT c.conv_id, t.i AS depth, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
    UNION ALL
    SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.i - c.h, t.role, t.text
    FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h LEFT JOIN heads b ON b.conv_id = c.base),
paths AS (
    SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
linked AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS up, max(depth) OVER (PARTITION BY conv_id) AS last FROM paths),
nodes AS (
    SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(up) AS up, max(words) AS words,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
    FROM linked GROUP BY depth, key),
children AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
totals AS (
    SELECT a.depth, a.key, count(*) FILTER (k.n IS NULL) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
    FROM nodes v JOIN paths a ON a.conv_id = v.conv_id AND a.depth <= v.depth LEFT JOIN children k ON k.depth = v.depth AND k.key = v.key
    GROUP BY a.depth, a.key)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, CAST(p.conv_id AS DOUBLE) AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children, t.n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v JOIN totals t ON t.depth = v.depth AND t.key = v.key LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.key = v.up
LEFT JOIN children k ON k.depth = v.depth AND k.key = v.key
"""
