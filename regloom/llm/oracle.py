"""SQL for the operators' queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
   md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
   [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1) AS level),
t AS (SELECT l.source, source_size, least(cap, weight * f.level) AS target FROM l, f),
c AS (SELECT d.*, source_size, target, copy, CASE WHEN target > 0 THEN (copy * source_size
      + sum(size) OVER (PARTITION BY d.source, copy ORDER BY k, size ROWS UNBOUNDED PRECEDING)) / target ELSE 0 END AS finish
   FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (SELECT unnest([0, 1]) AS copy)),
v AS (SELECT *, sum(size) OVER (ORDER BY finish, k, copy ROWS UNBOUNDED PRECEDING) <= 1.5 * (SELECT sum(size) FROM d) AS inside FROM c)
SELECT doc_id, size, source, source_size, target, CAST(sum(CASE WHEN inside THEN size ELSE 0 END) AS BIGINT) AS taken,
   count(*) FILTER (inside AND size > 0) AS copies FROM v GROUP BY ALL"""

NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * inter >= 75 * (na.n + nb.n - inter)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
least_ AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least_ USING (doc_id)"""

BASE32 = " + ".join(f"{16 >> k} * CAST(substr(bits, i * 5 + {k + 1}, 1) AS INT)" for k in range(5))
WARC = f"""
WITH b AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
   FROM pages),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {BASE32}, 1)), '') AS payload_digest FROM b),
g AS (SELECT payload_digest, max(page_id) AS response FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
   CASE WHEN page_id <> response THEN response END AS refers_to FROM d JOIN g USING (payload_digest)"""

FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS s FROM documents),
h AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(4), lambda k:
   CAST('0x' || substr(s, CAST(8 * k + 1 AS INT), 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
        WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
   coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(pre) END AS prefix_chars,
   CASE WHEN form <> 'plain' THEN len(mid) END AS middle_chars,
   sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
          ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
