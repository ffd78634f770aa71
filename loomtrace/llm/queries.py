"""Queries opN_<name> of this subpackage and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.llm.fingerprints import fingerprints
from loomtrace.llm.language import language_id
from loomtrace.llm.licenses import scan
from loomtrace.llm.media import text_media
from loomtrace.llm.mixing import mix
from loomtrace.llm.names import name_join, name_join_sql
from loomtrace.llm.near_duplicates import near_duplicates
from loomtrace.llm.oracles import REVISITS_SQL, licenses_sql, mixing_sql
from loomtrace.llm.quality import quality
from loomtrace.llm.ranked import ranked, ranked_sql
from loomtrace.llm.revisits import crawl_records, restored
from loomtrace.llm.sentencepiece import MODEL, load_model, round_trips
from loomtrace.llm.toxicity import toxicity
from loomtrace.llm.url_filter import filter_urls
from loomtrace.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_media")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as an image in an archive, read back and described."""
    return text_media(table(spark, sf_dir, "documents"))


@query("op2_revisits", REVISITS_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of all pages resolved to the responses that they repeat."""
    found = restored(crawl_records(table(spark, sf_dir, "pages")))
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda x: F.concat(x["key"], F.lit(": "), x["value"]))), "; ")
    return found.select(
        "record_id", "canonical", "kind", "resolution", "from_id", "status", shown.alias("headers"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_sha256"), F.length("payload").cast("long").alias("n_chars"),
    )


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by cross-parsing entropy."""
    return language_id(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by gradient-boosted trees."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a Jaccard index of 0.85 or more over five-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces and decoded again."""
    return round_trips(table(spark, sf_dir, "documents"), load_model(MODEL))


#: The rules that op7 judges urls by: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: What the title of a page has whose url is on the list of the query: three signs of noise in a row. It is a mark of the page, not of its host.
NOISY_TITLE = "<title>[^<]*[*#%$]{3}"

_OP7_SQL = f"""
WITH q AS (SELECT page_id, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
    list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM pages),
parsed AS (SELECT page_id, html, host, path, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical FROM q),
listed AS (SELECT DISTINCT canonical FROM parsed WHERE canonical IS NOT NULL AND regexp_matches(html, '{NOISY_TITLE}')),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN fits USING (host, path) LEFT JOIN listed l USING (canonical)
"""


@query("op7_url_filter", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url by the rules, else by the list: the urls of all pages with a noisy title."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(F.col("html").rlike(NOISY_TITLE)).select("url")
    return filter_urls(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"), listed)


@query("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints(table(spark, sf_dir, "documents"))


#: Names of the domains that sources fall into by their number, and weights of the mix: domain, lang, source, weight.
DOMAINS = ("web", "news", "books", "forums")
MIX_WEIGHTS = (
    ("web", None, None, 4), ("news", None, None, 2), ("books", None, None, 3), ("forums", None, None, 1),
    *((d, lang, None, w) for d in DOMAINS for lang, w in (("en", 4), ("de", 2), ("fr", 2), ("es", 1))),
)
WEIGHTS_SCHEMA = "domain string, lang string, source string, weight long"


def domain_of(source: Column) -> Column:
    """The domain of a source by the number at its end; ``other`` without one."""
    number = F.regexp_extract(source, r"(\d+)$", 1).try_cast("long")
    return F.coalesce(F.get(F.array(*map(F.lit, DOMAINS)), (number % len(DOMAINS)).cast("int")), F.lit("other"))


@query("op4_mixing", mixing_sql(0.5, 17, 4))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all tokens, mixed by the weights of domains and languages, with up to four epochs of a source."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, domain_of(docs["source"]), spark.createDataFrame(MIX_WEIGHTS, WEIGHTS_SCHEMA), share=0.5, seed=17, epochs=4)


@query("op5_licenses", licenses_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of all documents that are like a licence template."""
    return scan(table(spark, sf_dir, "documents"))


@query("op13_ranked_search", ranked_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_name_join", name_join_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors and clients whose names are at most two edits apart."""
    return name_join(table(spark, sf_dir, "vendors"), table(spark, sf_dir, "clients"))


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document by calibrated boosted trees."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
