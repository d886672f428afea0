"""SQL that must agree with the queries that SQL can express."""

from __future__ import annotations

from tarnlake.llm.lines import WINDOW
from tarnlake.llm.substring import SPAN
from tarnlake.llm.urls import (
    ADDRESS, AROUND, BAD_LIMIT, BAD_WORD, BOUND_Z, LEAST_WORDS, LOWER, MARKUP, REPEAT_PERCENT, RULES, STRENGTH, SYMBOL, SYMBOL_PERCENT,
    TWO_LABEL_SUFFIXES, UPPER, WINDOW_WORDS, WORD,
)

SUBSTRING = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, p, md5(array_to_string(words[p:p + {SPAN - 1}], ' ')) AS k
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - {SPAN - 2})) AS p FROM d)),
f AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k HAVING min(doc_id) <> max(doc_id)),
h AS (SELECT doc_id, p FROM w JOIN f USING (k) WHERE least < doc_id),
q AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
g AS (SELECT q.doc_id, q.p, word, max(CASE WHEN h.p IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY q.doc_id ORDER BY q.p ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW) AS gone
      FROM q LEFT JOIN h ON q.doc_id = h.doc_id AND q.p = h.p)
SELECT d.doc_id, count(g.p) AS n_words, coalesce(sum(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY g.p) FILTER (gone = 0), '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id GROUP BY d.doc_id
"""

_BLANKS = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"
LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p
           FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, p, line, trim(line, {_BLANKS}) AS s FROM l),
w AS (SELECT doc_id, p, s || chr(10) || lead(s, 1) OVER o || chr(10) || lead(s, 2) OVER o AS k FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
v AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM w WHERE replace(k, chr(10), '') <> ''),
r AS (SELECT DISTINCT doc_id, p + j AS p FROM (SELECT doc_id, p, unnest(range(0, {WINDOW})) AS j FROM v WHERE nth > 1))
SELECT d.doc_id, count(t.p) AS n_lines, count(r.p) AS n_removed_lines,
       CASE WHEN any_value(d.text) IS NOT NULL THEN sha256(coalesce(string_agg(t.line, chr(10) ORDER BY t.p) FILTER (r.p IS NULL), '')) END AS kept_sha256
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN r ON t.doc_id = r.doc_id AND t.p = r.p GROUP BY d.doc_id
"""


def _rule(value: str) -> str:
    whens = []
    for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        whens.append(f"WHEN ends_with('.' || host, '.{h}') AND starts_with(path, '/{p}') THEN '{rule if value == 'rule' else verdict}'")
    return f"CASE {' '.join(whens)} END"


def _level(name: str, source: str, n: str, bad: str, prior: str, out: str) -> str:
    """Two steps: the level's prior strength, then the shrunken rate."""
    low, high = STRENGTH
    v = f"({prior} * (1 - {prior}))"
    num = f"sum({n} * ({bad}::DOUBLE / {n} - {prior}) * ({bad}::DOUBLE / {n} - {prior}) - {v})"
    rho = f"greatest({1 / (1 + high)!r}::DOUBLE, least({1 / (1 + low)!r}::DOUBLE, coalesce({num} / nullif(sum(({n} - 1) * {v}), 0), 0)))"
    return (
        f"{name}_k AS (SELECT 1 / ({rho}) - 1 AS k FROM {source} WHERE {n} > 0 AND {v} > 0), "
        f"{name} AS (SELECT *, ({bad} + {prior} * k) / ({n} + k) AS {out}, {n} + k AS {out}_n FROM {source} CROSS JOIN {name}_k)"
    )


_LONG = f"regexp_extract(name, '([^.]*\\.[^.]*)$', 1) IN ({', '.join(repr(s) for s in TWO_LABEL_SUFFIXES)})"
_IP = f"regexp_matches(name, '{ADDRESS}')"
URLS = f"""
WITH u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
x AS (SELECT page_id, host, regexp_replace(html, '{MARKUP}', ' ', 'g') AS t FROM p WHERE page_id IS NOT NULL),
m AS (SELECT row_number() OVER () AS r, page_id, host, len(regexp_extract_all(t, '{SYMBOL}')) AS symbols, regexp_extract_all(t, '{WORD}') AS words FROM x),
v AS (SELECT r, count(*) AS w, count(DISTINCT array_to_string(words[i:i + {WINDOW_WORDS - 1}], ' ')) AS v
      FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW_WORDS - 2})) AS i FROM m) GROUP BY r),
y AS (SELECT page_id, bool_or(regexp_matches(host, '{BAD_WORD}') OR coalesce(len(words) < {LEAST_WORDS} OR symbols * 100 > len(words) * {SYMBOL_PERCENT}
             OR coalesce((w - v) * 100 > w * {REPEAT_PERCENT}, false), false)) AS bad
      FROM m LEFT JOIN v USING (r) GROUP BY 1),
h0 AS (SELECT host, regexp_replace(host, '{AROUND}', '', 'g') AS name, count(bad) AS n, count(*) FILTER (bad) AS bad FROM p LEFT JOIN y USING (page_id) GROUP BY host),
h AS (SELECT *, CASE WHEN {_IP} THEN name WHEN {_LONG} THEN regexp_extract(name, '([^.]*\\.)?([^.]*\\.[^.]*)$', 0) ELSE regexp_extract(name, '([^.]*\\.)?[^.]*$', 0) END AS domain,
             CASE WHEN {_IP} THEN '' WHEN {_LONG} THEN regexp_extract(name, '([^.]*\\.[^.]*)$', 1) ELSE regexp_extract(name, '[^.]*$', 0) END AS suffix FROM h0),
t AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) AS m0 FROM h),
s0 AS (SELECT suffix, sum(n) AS sn, sum(bad) AS sbad, any_value(m0) AS m0 FROM h CROSS JOIN t GROUP BY suffix),
{_level("s", "s0", "sn", "sbad", "m0", "sm")},
d0 AS (SELECT domain, suffix, sum(n) AS dn, sum(bad) AS dbad, any_value(sm) AS sm FROM h JOIN s USING (suffix) GROUP BY domain, suffix),
{_level("d", "d0", "dn", "dbad", "sm", "dm")},
e0 AS (SELECT host, h.n, h.bad, dm FROM h JOIN d USING (domain, suffix)),
{_level("e", "e0", "n", "bad", "dm", "rate")},
b AS (SELECT host, rate - {BOUND_Z} * sqrt(rate * (1 - rate) / (rate_n + 1)) AS bound FROM e)
SELECT page_id, host, path, {_rule("rule")} AS rule,
       coalesce({_rule("verdict")}, CASE WHEN bound > {BAD_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN b USING (host)
"""


def _finite(v: str) -> str:
    return f"{v} IS NOT NULL AND len([x FOR x IN {v} IF x IS NULL OR NOT isfinite(x)]) = 0"


#: Floor of s / n for any sign of s.
_MEAN = "(s - ((s % n) + n) % n) // n"


def _cluster_rounds(rounds: int) -> str:
    found = []
    for i in range(rounds + 1):
        found.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, min({{'d': d, 'c': c}}) AS m FROM (SELECT x.vec_id, c.c, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d "
            f"FROM x JOIN c{i} AS c USING (p) GROUP BY x.vec_id, c.c) GROUP BY vec_id)"
        )
        if i < rounds:
            found.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c.c, c.p, coalesce({_MEAN}, c.x)::BIGINT AS x FROM c{i} AS c LEFT JOIN (SELECT m.c AS c, p, sum(x)::BIGINT AS s, count(*) AS n "
                f"FROM a{i} JOIN x USING (vec_id) GROUP BY m.c, p) AS g ON c.c = g.c AND c.p = g.p)"
            )
    return ", ".join(found)


CLUSTERS = f"""
WITH k AS MATERIALIZED (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE len(embedding) = 64 AND {_finite("embedding")}),
x AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS p FROM k),
f AS (SELECT v, (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS c FROM k),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, unnest(range(64)) AS p FROM f WHERE c < 40),
{_cluster_rounds(5)}
SELECT vec_id, m.c AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a5 JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY p)) AS centroid_sha256 FROM c5 GROUP BY c) AS h ON m.c = h.c
"""

NEAR_VECTORS = f"""
WITH RECURSIVE u AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND {_finite("embedding")} AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
r AS (SELECT vec_id, vec_id AS near FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.near = l.a),
m AS (SELECT vec_id, min(near) AS component_id FROM r GROUP BY vec_id)
SELECT m.vec_id, coalesce(n, 0) AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) AS c ON m.vec_id = c.a
"""


def _code_rounds(rounds: int) -> str:
    found = []
    for i in range(rounds + 1):
        found.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, q, min({{'d': d, 'e': e}}) AS m FROM (SELECT x.vec_id, x.q, b.e, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS d "
            f"FROM x JOIN b{i} AS b USING (q, p) GROUP BY x.vec_id, x.q, b.e) GROUP BY vec_id, q)"
        )
        if i < rounds:
            found.append(
                f"b{i + 1} AS MATERIALIZED (SELECT b.q, b.e, b.p, coalesce({_MEAN}, b.x)::BIGINT AS x FROM b{i} AS b LEFT JOIN (SELECT q, m.e AS e, p, sum(x)::BIGINT AS s, count(*) AS n "
                f"FROM a{i} JOIN x USING (vec_id, q) GROUP BY q, m.e, p) AS g ON b.q = g.q AND b.e = g.e AND b.p = g.p)"
            )
    return ", ".join(found)


CODES = f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE {_finite("embedding")} AND len(embedding) = 64),
x AS MATERIALIZED (SELECT vec_id, x, i // 16 AS q, i % 16 AS p FROM (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS i FROM k)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k),
b0 AS MATERIALIZED (SELECT q, e, p, x FROM f JOIN x USING (vec_id) WHERE e < 256),
{_code_rounds(4)},
v AS (SELECT vec_id, any_value(label) AS label, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY q) AS code, sum(m.d)::BIGINT AS error FROM a4 JOIN k USING (vec_id) GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(x, ',' ORDER BY q, e, p)) FROM b4) AS codebooks_sha256 FROM v
"""
