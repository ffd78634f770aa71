"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from loomtrace.llm.licenses import TEMPLATES, THRESHOLD


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licenses_sql() -> str:
    """Every part of every document against every template of a size that may fit."""
    rows = ", ".join(f"({i}, {_text(n)}, {_text(t)})" for i, (n, t) in enumerate(TEMPLATES))
    words = "list_filter(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    grams = "CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END"
    low, high = THRESHOLD / (2 - THRESHOLD), (2 - THRESHOLD) / THRESHOLD
    return f"""
WITH t AS (SELECT template, licence, {grams} AS p FROM (SELECT template, licence, {words} AS w FROM (VALUES {rows}) v(template, licence, body))),
d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n\\s*') AS ps, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
parts AS (
  SELECT doc_id, 'text' AS part, 0 AS number, text AS body FROM d
  UNION ALL SELECT doc_id, 'paragraph', (generate_subscripts(ps, 1) - 1)::INT, unnest(ps) FROM d WHERE len(ps) > 1
  UNION ALL SELECT doc_id, 'line', (generate_subscripts(ls, 1) - 1)::INT, unnest(ls) FROM d WHERE len(ls) > len(ps)),
g AS (SELECT doc_id, part, number, {grams} AS g FROM (SELECT doc_id, part, number, {words} AS w FROM parts)),
m AS (SELECT doc_id, part, number, licence, template, 2 * len(list_intersect(g, p)) / (len(g) + len(p))::DOUBLE AS dice FROM g JOIN t ON len(g) BETWEEN len(p) * {low!r} - 1e-9 AND len(p) * {high!r} + 1e-9),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, part, number ORDER BY dice DESC, template) AS n FROM m WHERE dice >= {THRESHOLD})
SELECT doc_id, part, number, licence, template, dice FROM k WHERE n = 1
"""


REVISITS_SQL = """
WITH q AS (SELECT page_id, html, regexp_replace(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\\.', '') AS host,
    regexp_replace(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params FROM pages),
p AS (SELECT page_id, html, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || page_id AS day FROM q),
r AS (SELECT *, page_id * 2 AS record_id, page_id * 1000 AS ts FROM p),
v AS (SELECT page_id * 2 + 1 AS record_id, canonical, page_id * 1000 + 2500000 AS ts, day,
    CASE WHEN page_id % 13 = 1 THEN NULL WHEN page_id % 11 = 5 THEN '"other"' WHEN page_id % 7 = 3 THEN 'W/' || tag ELSE tag END AS sent FROM p),
a AS (SELECT v.record_id, any_value(v.canonical) AS canonical, any_value(v.day) AS day, any_value(v.sent) AS sent, max(struct_pack(ts := r.ts, id := r.record_id)) AS found FROM v LEFT JOIN r ON r.canonical = v.canonical AND r.ts < v.ts GROUP BY v.record_id),
j AS (SELECT a.*, r.record_id AS old_id, r.html, r.tag, r.day AS old_day,
    CASE WHEN r.record_id IS NULL THEN 'no-earlier-response' WHEN sent IS NOT NULL THEN CASE WHEN regexp_replace(sent, '^W/', '') = r.tag THEN 'resolved' ELSE 'validator-mismatch' END
         WHEN a.day = r.day THEN 'resolved' ELSE 'validator-mismatch' END AS resolution
    FROM a LEFT JOIN r ON r.record_id = a.found.id)
SELECT record_id, canonical, 'response' AS kind, 'full' AS resolution, record_id AS from_id, 200 AS status,
  'cache-control: max-age=60; content-length: ' || length(html) || '; content-type: text/html; etag: ' || tag || '; last-modified: ' || day AS headers, sha256(html) AS payload_sha256, length(html)::BIGINT AS n_chars FROM r
UNION ALL SELECT record_id, canonical, 'revisit', resolution, old_id, 200,
  'cache-control: no-cache; content-length: ' || length(html) || '; content-type: text/html; date: now; etag: ' || coalesce(sent, tag) || '; last-modified: ' || day, sha256(html), length(html)::BIGINT FROM j WHERE resolution = 'resolved'
UNION ALL SELECT record_id, canonical, 'revisit', resolution, NULL, 304,
  'cache-control: no-cache; content-length: 0; date: now' || coalesce('; etag: ' || sent, '') || '; last-modified: ' || day, NULL, NULL FROM j WHERE resolution <> 'resolved'
"""


def _share(source: str, keys: list[str], weight: str, parent: str | None) -> str:
    """One level of the tree: the budget of ``parent`` shared among the nodes of ``source``."""
    above, name, names = ", ".join(keys[:-1]), keys[-1], ", ".join(keys)
    family = f"PARTITION BY {above}" if above else ""
    budget = f"JOIN {parent} USING ({above})" if parent else "CROSS JOIN total"
    return f"""(
  WITH n AS (SELECT {names}, sum(cap)::HUGEINT AS cap, any_value({weight})::HUGEINT AS weight FROM {source} GROUP BY {names}),
  b AS (SELECT n.*, budget::HUGEINT AS budget, cap::DOUBLE / weight AS ratio FROM n {budget}),
  f AS (SELECT *, cap * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= (budget - (sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap)) * weight AS is_full FROM b WINDOW o AS ({family} ORDER BY ratio, {name})),
  s AS (SELECT *, CASE WHEN is_full THEN cap ELSE weight * (budget - coalesce(sum(cap) FILTER (is_full) OVER ({family}), 0)) // sum(weight) FILTER (NOT is_full) OVER ({family}) END AS part,
     sum((NOT is_full)::INT) OVER ({family} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM f)
  SELECT {names}, part + CASE WHEN NOT is_full AND place <= budget - sum(part) OVER ({family}) THEN 1 ELSE 0 END AS budget FROM s)"""


def mixing_sql(share: float, seed: int, epochs: int) -> str:
    """The mix of op4: the weights are those of ``queries.MIX_WEIGHTS``."""
    return f"""
WITH t AS (SELECT doc_id, coalesce(['web', 'news', 'books', 'forums'][try_cast(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) % 4 + 1], 'other') AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, md5(coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS supply, sum(tokens)::HUGEINT * {epochs} AS cap,
    CASE domain WHEN 'web' THEN 4 WHEN 'news' THEN 2 WHEN 'books' THEN 3 ELSE 1 END AS w1, CASE WHEN domain = 'other' THEN 1 WHEN lang = 'en' THEN 4 WHEN lang IN ('de', 'fr') THEN 2 ELSE 1 END AS w2, 1 AS w3 FROM t GROUP BY domain, lang, source),
total AS (SELECT least(sum(cap), floor(sum(supply) * {share})::HUGEINT) AS budget FROM leaves),
one AS {_share("leaves", ["domain"], "w1", None)},
two AS {_share("leaves", ["domain", "lang"], "w2", "one")},
three AS {_share("leaves", ["domain", "lang", "source"], "w3", "two")},
plan AS (SELECT domain, lang, source, (budget // supply)::INT AS whole, (budget % supply)::BIGINT AS rest FROM three JOIN leaves USING (domain, lang, source) WHERE supply > 0),
d AS (SELECT t.*, whole, rest, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null') || ':' || digest), doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS start FROM t JOIN plan USING (domain, lang, source) WHERE tokens > 0)
SELECT doc_id, domain, lang, source, unnest(range(whole))::INT AS epoch, tokens AS n_tokens, tokens AS taken FROM d
UNION ALL SELECT doc_id, domain, lang, source, whole, tokens, least(tokens, rest - start)::BIGINT FROM d WHERE start < rest
"""
