"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .url_filter import RULES, SOFT, SOFT_LIMIT, STRICT

OP1 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

_WORD = "regexp_matches(low, '(^|[^a-z0-9])({0})([^a-z0-9]|$)')"


def _op6() -> str:
    fits = " UNION ALL ".join(
        f"SELECT page_id, url, '{v}' AS v, '{h}{p}' AS r FROM p WHERE (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')" for v, h, p in RULES
    )
    strict = " + ".join(f"({_WORD.format(t)})::INT" for t in STRICT)
    soft = " + ".join(f"({_WORD.format(t)})::INT" for t in SOFT)
    return f"""
WITH u AS (SELECT page_id, url, lower(coalesce(url, '')) AS low, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT *, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS ({fits}),
b AS (SELECT page_id, url, arg_max(v, length(r)) AS v, arg_max(r, length(r)) AS r FROM f GROUP BY page_id, url),
h AS (SELECT *, {strict} AS strict_hits, {soft} AS soft_hits FROM p)
SELECT h.page_id, h.host, h.path, b.r AS rule,
       coalesce(b.v, CASE WHEN strict_hits > 0 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits::INT AS strict_hits, soft_hits::INT AS soft_hits
FROM h LEFT JOIN b ON h.page_id IS NOT DISTINCT FROM b.page_id AND h.url = b.url
"""


OP10 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM w),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level FROM o),
v AS (SELECT level AS lv FROM l WHERE level * w <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT lv FROM v), 1e300) * w) AS target FROM l),
r AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM t),
j AS (SELECT d.doc_id, d.source, d.size, r.source_size, r.target, floor(ratio) AS whole, ratio - floor(ratio) AS p,
             (('0x' || substr(md5('mix' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rnk FROM j),
f AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rnk, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM q),
e AS (SELECT *, (whole + CASE WHEN p > 0 AND filled - size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END)::BIGINT AS copies FROM f)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, source, copies FROM e
"""

OP5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 13 THEN range(1, len(w) - 11) ELSE []::BIGINT[] END) AS pos FROM d),
g AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 12], ' ') AS win FROM p),
f AS (SELECT win, min(doc_id) AS least FROM g GROUP BY win HAVING min(doc_id) < max(doc_id)),
h AS (SELECT DISTINCT g.doc_id, g.pos + o.o AS pos FROM g JOIN f USING (win), (SELECT unnest(range(0, 13)) AS o) o WHERE f.least < g.doc_id),
e AS (SELECT d.doc_id, w.word, w.pos FROM d, LATERAL (SELECT unnest(d.w) AS word, unnest(range(1, len(d.w) + 1)) AS pos) w),
k AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.pos) AS kept, count(*) AS n FROM e ANTI JOIN h ON e.doc_id = h.doc_id AND e.pos = h.pos GROUP BY e.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP4 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

ORACLES: dict[str, str] = {
    "op1_exact_dedup": OP1,
    "op4_ngram_jaccard_join": OP4,
    "op5_substring_dedup": OP5,
    "op6_url_filters": _op6(),
    "op10_mixing": OP10,
}
