"""DuckDB SQL with the rows of those queries that SQL can express on whole tables."""

from __future__ import annotations

from .url_graph import ABOVE, BLOCK_FROM, DAMPING, LINK, NO_HOST, OTHER_HOST, RULES
from .zip_warc import LEAST

#: Rounds of the walk in SQL, which cannot stop by itself: enough for chains of hosts up to this length, and for any graph to 0.85^40.
SQL_ROUNDS = 40

OP3 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), o AS (
  SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w
), q AS (
  SELECT r, i, x, lead(x, 1) OVER v AS y, lead(x, 2) OVER v AS z FROM o WINDOW v AS (PARTITION BY r ORDER BY i)
), g AS (
  SELECT r, unnest(i) AS i, n FROM (SELECT r, list(i) AS i, count(*) AS n FROM q WHERE z IS NOT NULL GROUP BY r, x, y, z HAVING count(*) > 1)
), p AS (
  SELECT r, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY r
), l AS (
  SELECT r, count(*) - count(DISTINCT s) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM d) WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT d.doc_id, d.source, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN p USING (r) LEFT JOIN l USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM b WHERE source IS NOT NULL GROUP BY source
), a AS (
  SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h
), s AS (
  SELECT source, CASE WHEN v > 0 THEN (f + m * greatest(m * (1 - m) / v - 1, 0)) / (n + greatest(m * (1 - m) / v - 1, 0)) ELSE m END AS rate FROM h, a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(rate >= 0.5, false) AS kept
FROM b LEFT JOIN s USING (source)
"""

OP10 = f"""
WITH d AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), g AS (
  SELECT h, min(page_id) AS first FROM d WHERE strlen(h) >= {LEAST} GROUP BY h
)
SELECT page_id, CAST(strlen(d.h) AS BIGINT) AS payload_bytes, sha256(d.h) AS payload_digest,
  CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM d LEFT JOIN g USING (h)
"""


def _op9() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    whens, verdicts = [], []
    for what, rule in sorted(RULES, key=lambda r: (len(r[1]), r[1]), reverse=True):
        host, slash, path = rule.partition("/")
        fits = f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}'))"
        whens.append(f"WHEN {fits} THEN '{rule}'")
        verdicts.append(f"WHEN {fits} THEN '{what}'")
    link = LINK.replace("'", "''")
    mass = lambda x, net: f"({1 - DAMPING!r} * k.{x}0 + {DAMPING!r} * coalesce(g.{x}, 0)) / k.{net} AS {x}, coalesce(g.{x}, 0) AS g{x}"
    every = ", ".join(mass(x, net) for x, net in (("t", "net_out"), ("v", "net_out"), ("d", "net_in"), ("u", "net_in")))
    steps = "".join(
        f"""
), r{i + 1} AS MATERIALIZED (
  SELECT k.host, {every}
  FROM k LEFT JOIN (
    SELECT host, sum(t) AS t, sum(v) AS v, sum(d) AS d, sum(u) AS u FROM (
      SELECT e.dst AS host, r.t * e.n / k.all_out AS t, r.v * e.n / k.all_out AS v, 0.0 AS d, 0.0 AS u FROM e JOIN r{i} r ON e.src = r.host JOIN k ON k.host = e.src
      UNION ALL SELECT e.src, 0.0, 0.0, r.d * e.n / k.all_in, r.u * e.n / k.all_in FROM e JOIN r{i} r ON e.dst = r.host JOIN k ON k.host = e.dst
    ) GROUP BY host
  ) g USING (host)"""
        for i in range(SQL_ROUNDS)
    )
    return rf"""
WITH p AS (
  SELECT page_id, html, coalesce({lower.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), j AS MATERIALIZED (
  SELECT *, CASE {" ".join(whens)} END AS rule, CASE {" ".join(verdicts)} END AS ruled FROM p
), l AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS url FROM p WHERE host <> ''
), a AS MATERIALIZED (
  SELECT src, dst, count(*) AS n FROM (
    SELECT src, CASE WHEN regexp_matches(url, '{OTHER_HOST}')
      THEN {lower.format("regexp_extract(CASE WHEN starts_with(url, '//') THEN 'http:' || url ELSE url END, '(?s)^.*?://([^/?#]*)', 1)")} ELSE src END AS dst
    FROM l WHERE regexp_matches(url, '{OTHER_HOST}') OR NOT regexp_matches(url, '{NO_HOST}')
    UNION ALL SELECT host, regexp_extract(host, '{ABOVE}', 1) FROM p WHERE host <> ''
  ) WHERE dst <> '' GROUP BY src, dst
), e AS MATERIALIZED (SELECT * FROM a WHERE src <> dst
), o AS (SELECT src AS host, sum(n) AS n, sum(n) FILTER (WHERE src = dst) AS own FROM a GROUP BY src
), f AS (SELECT dst AS host, sum(n) AS n, sum(n) FILTER (WHERE src = dst) AS own FROM a GROUP BY dst
), s AS (
  SELECT host, count(*) FILTER (WHERE ruled = 'allow') / count(*) AS t, count(*) FILTER (WHERE ruled = 'block') / count(*) AS d
  FROM j WHERE host <> '' GROUP BY host
), k AS MATERIALIZED (
  SELECT host, coalesce(s.t, 0) AS t0, coalesce(s.d, 0) AS d0, 1.0::DOUBLE AS v0, 1.0::DOUBLE AS u0, o.n AS all_out, f.n AS all_in,
    1 - {DAMPING!r} * CASE WHEN o.n IS NULL THEN 1 ELSE coalesce(o.own, 0) / o.n END AS net_out, 1 - {DAMPING!r} * CASE WHEN f.n IS NULL THEN 1 ELSE coalesce(f.own, 0) / f.n END AS net_in
  FROM (SELECT host FROM s UNION SELECT src FROM a UNION SELECT dst FROM a) LEFT JOIN s USING (host) LEFT JOIN o USING (host) LEFT JOIN f USING (host)
), r0 AS MATERIALIZED (
  SELECT k.host, {every} FROM k LEFT JOIN (SELECT host, 0.0 AS t, 0.0 AS v, 0.0 AS d, 0.0 AS u FROM k WHERE false) g USING (host){steps}
), h AS (
  SELECT host, greatest(t0, CASE WHEN gv > 0 THEN gt / gv ELSE 0 END) AS trust, greatest(d0, CASE WHEN gu > 0 THEN gd / gu ELSE 0 END) AS distrust
  FROM r{SQL_ROUNDS} JOIN k USING (host)
)
SELECT page_id, j.host AS host, path, rule, coalesce(ruled, CASE WHEN distrust > trust AND distrust >= {BLOCK_FROM} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN h ON h.host = j.host
"""


OP8 = r"""
WITH RECURSIVE d AS (
  SELECT DISTINCT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), o AS (
  SELECT doc_id, len(w) AS k, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w
), q AS (
  SELECT doc_id, k, x, lead(x, 1) OVER v AS y, lead(x, 2) OVER v AS z, i FROM o WINDOW v AS (PARTITION BY doc_id ORDER BY i)
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, x, y, z FROM q WHERE k >= 3 AND z IS NOT NULL OR k < 3 AND i = 1
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM s a JOIN s b ON a.x = b.x AND a.y IS NOT DISTINCT FROM b.y AND a.z IS NOT DISTINCT FROM b.z AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), l AS MATERIALIZED (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n r ON r.doc_id = b WHERE 100 * m >= 90 * (p.n + r.n - m)
), e AS MATERIALIZED (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b
)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""

SQL = {"op8_jaccard_join": OP8, "op3_pivot_topk": OP3, "op4_quality_rules": OP4, "op9_url_filter": _op9(), "op10_zip_warc": OP10}
