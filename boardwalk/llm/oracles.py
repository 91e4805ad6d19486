"""DuckDB SQL of the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '(?:[0-9a-z]|[^\x00-\x7F])+')"

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""

OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, list_slice(ws, s, s + 9) AS win
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM i WHERE len(ws) > 0)),
n AS (SELECT DISTINCT len(win) AS n FROM w),
g AS (SELECT rid, s, n, list_slice(ws, s, s + n - 1) AS win
      FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, n WHERE len(ws) >= n)),
h AS (SELECT rid, s, n, item_id FROM g JOIN w ON g.win = w.win),
p AS (SELECT rid, count(DISTINCT p) AS n_hit
      FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM h)) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY rid)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p ON d.rid = p.rid LEFT JOIN t ON d.rid = t.rid
"""

OP10 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""

_TERMS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '(?:[a-z]|[^\x00-\x7F])+')"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS ts FROM documents),
t AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
x AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.total, coalesce(x.n, 0) AS n
      FROM g JOIN k ON g.lang = k.lang LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
s AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) + count(*) AS size FROM c GROUP BY lang, source),
a AS (SELECT lang, CAST(sum(total) AS HUGEINT) + count(*) AS size FROM k GROUP BY lang),
p AS (SELECT c.lang, c.source, c.term, c.n, 1 + (CAST(1000000000 AS HUGEINT) * (c.n + 1)) // s.size AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (c.total + 1)) // a.size AS q
      FROM c JOIN s ON c.lang = s.lang AND c.source = s.source JOIN a ON c.lang = a.lang),
f AS (SELECT u.lang, u.source, w.source AS item, sum(((u.p - w.p) * (u.p - w.p)) // w.p) AS value
      FROM p u JOIN p w ON u.lang = w.lang AND u.term = w.term AND u.source <> w.source GROUP BY u.lang, u.source, w.source),
r AS (SELECT u.lang, u.source, 'pair' AS part, w.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g u JOIN g w ON u.lang = w.lang AND u.source <> w.source
      LEFT JOIN f ON f.lang = u.lang AND f.source = u.source AND f.item = w.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": OP5, "op7_decontamination": OP7, "op10_warc": OP10, "op12_source_divergence": OP12}
