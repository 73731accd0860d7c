"""DuckDB SQL for the queries that SQL can express. The others learn, score or pack, and are tested against brute force."""

from __future__ import annotations

from .common import UPPER

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_ALNUM = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN = rf"regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+')"

OP1 = f"""WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents), b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) r(i) WHERE len(w) > 0),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM win) k, unnest(range(1, greatest(len(w) - n + 2, 1))) r(i)),
found AS (SELECT doc_id, item_id, i, n FROM grams JOIN win USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) r(j) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""

_BIT = " + ".join(f"{16 >> k} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INT)" for k in range(5))
OP4 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), s AS (SELECT page_id, strlen(h) AS n, CAST(unhex(sha1(h)) AS BIT)::VARCHAR AS bits FROM p), m AS (SELECT *, max(page_id) OVER (PARTITION BY bits) AS best FROM s)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_BIT}, 1)), '') AS payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to FROM m"""

OP5 = f"""WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM d),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, k.b FROM reach r JOIN either k ON k.a = r.b)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = s.doc_id) AS component_id FROM s"""

_LETTERS = rf"regexp_extract_all({_LOW}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
OP13 = f"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i, {_LETTERS} AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
tok AS (SELECT lang, source, i, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM tok GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
cnt AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM tok JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
lang_n AS (SELECT lang, sum(c) AS n, count(*) AS v FROM kept GROUP BY 1),
n AS (SELECT lang, source, sum(c) AS n FROM cnt GROUP BY 1, 2),
share AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * l.v)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (k.c + 2)) // (l.n + 2 * l.v)::HUGEINT AS q
  FROM grp g JOIN kept k USING (lang) JOIN lang_n l USING (lang) LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
dist AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN dist d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM share WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank FROM ranked WHERE part = 'pair' OR r <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1, "op4_warc": OP4, "op5_jaccard_join": OP5, "op13_source_audit": OP13}
