"""DuckDB SQL for the queries that SQL can express, in plain form and over whole tables."""

OP1 = r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), g AS (
    SELECT doc_id, unnest(range(1, len(ws) - 11)) AS pos, ws FROM w WHERE len(ws) >= 13
), h AS (
    SELECT doc_id, pos, md5(array_to_string(ws[pos : pos + 12], ' ')) AS k FROM g
), r AS (
    SELECT doc_id, list(pos) AS ats FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY k) AS low FROM h) WHERE low < doc_id GROUP BY doc_id
), c AS (
    SELECT doc_id, list_distinct(flatten(list_transform(ats, lambda a: range(a, a + 13)))) AS gone FROM r
), k AS (
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
        CASE WHEN gone IS NULL THEN array_to_string(ws, ' ') ELSE (
            SELECT coalesce(string_agg(x, ' ' ORDER BY i), '') FROM (SELECT unnest(ws) AS x, generate_subscripts(ws, 1) AS i) WHERE NOT list_contains(gone, i)
        ) END AS kept
    FROM w LEFT JOIN c USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(kept) AS kept_sha256 FROM k
"""

OP3 = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM documents
), n AS (
    SELECT doc_id, line, ord, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k FROM l
), s AS (
    SELECT doc_id, ord, k, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rn,
        lead(k) OVER (PARTITION BY doc_id ORDER BY ord) AS nx FROM n WHERE k <> ''
), d AS (
    SELECT doc_id, rn FROM (SELECT doc_id, rn, row_number() OVER (PARTITION BY k, nx ORDER BY doc_id, rn) AS place FROM s WHERE nx IS NOT NULL) WHERE place > 1
), e AS (
    SELECT doc_id, ord FROM (SELECT doc_id, ord, k, row_number() OVER (PARTITION BY k ORDER BY doc_id, rn) AS place FROM s)
    WHERE place > 1 AND len(list_filter(regexp_split_to_array(k, '[\x20\x09-\x0D]+'), lambda x: x <> '')) >= 13
), g AS (
    SELECT s.doc_id, s.ord FROM s JOIN d ON s.doc_id = d.doc_id AND s.rn IN (d.rn, d.rn + 1) UNION SELECT doc_id, ord FROM e
), t AS (
    SELECT n.doc_id, count(*) FILTER (k <> '') AS n_lines, count(g.ord) AS n_removed,
        string_agg(line, chr(10) ORDER BY n.ord) FILTER (g.ord IS NULL) AS kept
    FROM n LEFT JOIN g ON n.doc_id = g.doc_id AND n.ord = g.ord GROUP BY n.doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN n_removed > 0 AND n_removed = n_lines THEN '' ELSE coalesce(kept, '') END) AS kept_sha256
FROM documents d LEFT JOIN t USING (doc_id)
"""

OP7 = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), b AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, len(ws[pos : pos + 12]) AS size, array_to_string(ws[pos : pos + 12], ' ') AS k
    FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS pos FROM b WHERE len(ws) > 0)
), sizes AS (
    SELECT DISTINCT size FROM bw
), dw AS (
    SELECT doc_id, pos, size, array_to_string(ws[pos : pos + size - 1], ' ') AS k
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS pos FROM d, sizes WHERE len(ws) >= size)
), m AS (
    SELECT doc_id, pos, dw.size, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.size = bw.size
), h AS (
    SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS w FROM m) GROUP BY doc_id
), i AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM m GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), FALSE) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

OP8 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[pos : pos + 3], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS pos FROM w WHERE len(ws) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
    SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2)
    JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)
), r AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
)
SELECT x AS doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(y) AS component_id FROM r LEFT JOIN n ON n.doc_id = x GROUP BY x
"""

#: crc32 is built from its table; equal runs of five words less than a quarter of the text apart give the matches.
OP12 = r"""
WITH bits AS (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i)
), tab AS (
    SELECT list(c ORDER BY i) AS crc FROM bits
), d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
            lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
    FROM documents, tab
), e AS (
    SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS chosen, (h // 10) % greatest(len(ws), 1) AS a, h // 10 AS g FROM d
), f AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e
), w AS (
    SELECT doc_id, CASE WHEN chosen THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws, n FROM f
), g5 AS (
    SELECT doc_id, n, i, array_to_string(ws[i + 1 : i + 5], ' ') AS k FROM (SELECT doc_id, ws, n, unnest(range(n - 4)) AS i FROM w WHERE n > 5)
), m AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM g5 x JOIN g5 y ON x.doc_id = y.doc_id AND x.k = y.k AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), s AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m
), t AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM s GROUP BY doc_id, q, island
), r AS (
    SELECT doc_id, start, length, min(q) AS period FROM t WHERE length >= 6 AND length >= 4 * q GROUP BY doc_id, start, length
), o AS (
    SELECT doc_id, count(*) AS n_runs, first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS line FROM r GROUP BY doc_id
), x AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r
), k AS (
    SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS kept
    FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(n)) AS i FROM w) u ANTI JOIN x ON u.doc_id = x.doc_id AND u.i = x.i GROUP BY u.doc_id
)
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
    CAST(best.period AS BIGINT) AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
    sha256(coalesce(line, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)
"""
