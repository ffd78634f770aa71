"""Queries of urls, pages and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtrace.functions.metrics import METRICS
from loomtrace.functions import times as D
from loomtrace.functions import urls as U
from loomtrace.plans.registry import query
from loomtrace.sources.tables import table


@query("q_url_canonical", """WITH p AS (SELECT page_id, lower(regexp_extract(url, '^(\\w+)://', 1)) AS scheme, lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, scheme || '://' || regexp_replace(CASE WHEN regexp_matches(host, '^www\\.[^.]+\\.[^.]+$') THEN substr(host, 5) ELSE host END, '\\.[^.]+$', '') || CASE WHEN path = '/' THEN '' ELSE path END AS form FROM p""")
def url_canonical(spark, sf_dir):
    """Page urls in the form that comparison uses, without query and fragment."""
    return table(spark, sf_dir, "pages").select("page_id", U.compare_form(F.col("url"), full=False).alias("form"))


@query("q_url_query_keys", "SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref FROM pages")
def url_query_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.query_value(F.col("url"), "page").alias("page"), U.query_value(F.col("url"), "ref").alias("ref"))


@query("q_url_dash_part", "SELECT page_id, regexp_replace(string_split(url, '/')[4], '\\?.*$', '') AS lang, regexp_replace(string_split(url, '/')[-1], '\\?.*$', '') AS last FROM pages")
def url_dash_part(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.path_part(F.col("url"), 3).alias("lang"), U.path_part(F.col("url"), -1).alias("last"))


@query("q_url_pattern_all", "SELECT page_id, (regexp_matches(url, '^https') AND regexp_matches(url, '/en/') AND regexp_matches(url, '\\d+'))::DOUBLE AS score FROM pages")
def url_pattern_all(spark, sf_dir):
    score = METRICS["is_expected_url_pattern_match"](F.col("url"), {"expected": ["^https", "/en/", r"\d+"]})
    return table(spark, sf_dir, "pages").select("page_id", score.alias("score"))


@query("q_url_without_query", "SELECT page_id, regexp_replace(url, '\\?[^#]*', '') AS url FROM pages")
def url_without_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.without_query(F.col("url")).alias("url"))


@query("q_html_text", """WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS t FROM pages)
SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g'))) AS body FROM t""")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(U.html_text(F.col("html")).cast("binary")).alias("body"))


@query("q_html_attributes", """SELECT page_id, len(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref="([^"]*)"', 1)) AS links, regexp_extract(html, '(?is)<html\\b[^>]*?\\blang="([^"]*)"', 1) AS lang FROM pages""")
def html_attributes(spark, sf_dir):
    links, lang = U.html_attributes(F.col("html"), "a", "href"), U.html_attributes(F.col("html"), "html", "lang")
    return table(spark, sf_dir, "pages").select("page_id", F.size(links).cast("long").alias("links"), F.coalesce(F.try_element_at(lang, F.lit(1)), F.lit("")).alias("lang"))


@query("q_time_relative", """WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT o_orderkey, d + 1 AS tomorrow, least(date_trunc('month', d + INTERVAL 1 MONTH)::DATE + 30, last_day(date_trunc('month', d) + INTERVAL 1 MONTH)) AS day31, (date_trunc('week', d)::DATE + 4) AS this_friday, (date_trunc('week', d)::DATE + 13) AS next_sunday,
  (date_trunc('month', d) + INTERVAL 4 MONTH)::DATE + ((8 - isodow((date_trunc('month', d) + INTERVAL 4 MONTH)::DATE)) % 7)::INT AS first_monday, strftime(d + 1, '%a, %b %d %Y') AS shown FROM d""")
def time_relative(spark, sf_dir):
    """Days that phrases name, seen from each order's date."""
    d = F.col("o_orderdate").cast("date")
    day = lambda phrase: D.relative_day(d, phrase)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day("tomorrow").alias("tomorrow"), day("31st next month").alias("day31"), day("this Friday").alias("this_friday"), day("next week Sunday").alias("next_sunday"),
        day("first Monday 4 months later").alias("first_monday"), D.formatted(day("tomorrow"), "{DoW}, {Month} {Day0D} {Year}").alias("shown"),
    )


@query("q_chrome_epoch", "SELECT event_id, epoch_us(ts) + 11644473600000000 AS micros, ts AS visited FROM events")
def chrome_epoch(spark, sf_dir):
    micros = D.to_browser_time(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", micros.alias("micros"), D.browser_time(micros).alias("visited"))


@query("q_json_canonical", """WITH c AS (SELECT click_id, props::JSON AS p FROM clicks WHERE json_valid(props)),
k AS (SELECT click_id, json_extract(p, '$.k')::VARCHAR AS k, json_extract(p, '$.device.os')::VARCHAR AS os, json_extract(p, '$.device.ver')::VARCHAR AS ver, json_type(p, '$.device') AS dt, json_type(p, '$.tags') AS tt, json_type(p, '$.items') AS it,
  list_sort(CASE WHEN json_type(p, '$.tags') = 'ARRAY' THEN json_extract(p, '$.tags[*]')::VARCHAR[] END) AS tags,
  list_sort(CASE WHEN json_type(p, '$.items') = 'ARRAY' THEN list_transform(json_extract(p, '$.items[*]'), lambda x: json_extract(x, '$.sku')::VARCHAR || ':' || json_extract(x, '$.qty')::VARCHAR) END) AS items FROM c)
SELECT min(click_id) AS first_click, count(*) AS clicks FROM k GROUP BY k, os, ver, dt, tt, it, tags, items""")
def json_canonical(spark, sf_dir):
    """Clicks whose properties are one value, lists in any order: the first click of each and how many."""
    from loomtrace.functions.json_hash import json_hash

    # Equal texts are read once.
    texts = table(spark, sf_dir, "clicks").groupBy("props").agg(F.min("click_id").alias("first_click"), F.count("*").alias("clicks"))
    rows = texts.withColumn("value", json_hash(F.col("props"), ignore_order=True)).filter("value is not null")
    return rows.groupBy("value").agg(F.min("first_click").alias("first_click"), F.sum("clicks").alias("clicks")).drop("value")


@query("q_public_suffix", """WITH h AS (SELECT page_id, lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS host FROM pages)
SELECT CASE WHEN regexp_matches(host, '\\.example\\.(com|net|org)$') THEN regexp_extract(host, '(example\\.[a-z]+)$', 1) END AS domain, CASE WHEN host <> '' THEN regexp_extract(host, '([^.]*)$', 1) END AS suffix, count(*) AS pages, count(DISTINCT host) AS hosts FROM h GROUP BY ALL""")
def public_suffix(spark, sf_dir):
    """Pages and hosts of each registrable domain, with its suffix by a join with the table of rules."""
    from loomtrace.functions.suffixes import SUFFIX_RULES, registrable_domain, with_suffix

    host = F.lower(F.regexp_extract("url", r"://([^/?#:]*)", 1))
    pages = table(spark, sf_dir, "pages").select("page_id", host.alias("host"))
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    rows = with_suffix(pages, rules).withColumn("domain", registrable_domain(F.col("host")))
    return rows.groupBy("domain", "suffix").agg(F.count("*").alias("pages"), F.countDistinct("host").alias("hosts"))
