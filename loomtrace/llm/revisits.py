"""WARC revisits: a not-modified record takes its payload from the latest earlier full response of its url.

The as-of join goes by canonical url. Time is cut into pieces at quantiles; within a
piece a window finds the latest earlier response, and where it finds none the last
response of the pieces before is used, of which there is one row for each url and
piece. So a url with a third of all records is spread over as many tasks as there are
pieces. Payloads stay out of the join; a response that many revisits repeat is joined
in several copies, each to a part of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.pieces import with_pieces
from loomtrace.llm.scratch import Scratch
from loomtrace.llm.url_filter import canonical_url

#: Records of a piece of time that are aimed at.
PIECE_ROWS = 5_000
#: Rows that one copy of a source is joined to, and sources that are copied at most.
COPY_ROWS, HOT_SOURCES = 500, 100_000

# Fields that a not-modified answer must not change in a stored one
# (they describe its body), and fields of one connection only.
NOT_PERMITTED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def plain_headers(headers: Column) -> Column:
    """The map with lower-cased names; of names that are then alike the greatest value counts, a null last."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    low = F.array_distinct(F.transform(entries, lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value"))))
    greater = lambda y, x: F.coalesce(y["value"] > x["value"], x["value"].isNull() & y["value"].isNotNull())
    return F.map_from_entries(F.filter(low, lambda x: ~F.exists(low, lambda y: (y["key"] == x["key"]) & greater(y, x))))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """``stored`` with the permitted fields of ``fresh`` in place of its own; both by ``plain_headers``."""
    permitted = F.map_filter(fresh, lambda k, v: ~k.isin(*NOT_PERMITTED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(permitted, k)), permitted)


def _verdict(etag: Column, old_etag: Column, modified: Column, old_modified: Column, digest: Column, old_digest: Column) -> Column:
    """How the validators of a revisit and of the earlier response agree.

    Payload digests must be equal where both have one. Entity tags decide if both have
    one, compared weakly; else the dates of modification do; else equal digests are enough.
    """
    tag = lambda x: F.regexp_replace(x, "^W/", "")
    both = lambda a, b: a.isNotNull() & b.isNotNull()
    agree = lambda same: F.when(same, "resolved").otherwise("validator-mismatch")
    return (
        F.when(both(digest, old_digest) & (digest != old_digest), "validator-mismatch")
        .when(both(etag, old_etag), agree(tag(etag) == tag(old_etag)))
        .when(both(modified, old_modified), agree(modified == old_modified))
        .when(both(digest, old_digest), "resolved")
        .otherwise("no-validator")
    )


def _join_sources(rows: DataFrame, sources: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` left joined to ``sources`` (one row a key, the last of which is an id); rows with a null id match nothing.

    A source that more than COPY_ROWS rows ask for is copied so often that no copy has
    many more; they are HOT_SOURCES at most and broadcast, as the least number of rows
    that makes a source hot grows with all rows. Rows without a source are dealt by
    their own id, not all to the task of the null.
    """
    name = key[-1]
    asked = rows.filter(F.col(name).isNotNull())
    least = max(COPY_ROWS, asked.count() // HOT_SOURCES)
    hot = asked.groupBy(*key).count().filter(F.col("count") > least).select(*key, F.ceil(F.col("count") / least).cast("int").alias("__copies"))
    spread = F.xxhash64("record_id")
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__copy", F.when(F.col(name).isNull(), spread).otherwise(F.pmod(spread, F.coalesce("__copies", F.lit(1)))))
    copies = sources.join(F.broadcast(hot), key, "left").withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__copies", F.lit(1)) - 1)))
    return dealt.drop("__copies").join(copies.drop("__copies"), [*key, "__copy"], "left").drop("__copy")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(record_id, canonical, kind, resolution, from_id, status, headers) for every row of ``records``.

    ``records`` has record_id, url, ts (any whole number), kind (``response`` or
    ``revisit``), status and headers (a map; the payload digest is its field
    ``warc-payload-digest``). A response with status 200 is full. Full responses are
    their own source (``full``), other responses are left alone (``other``). A revisit
    looks to the full response of its canonical url with the greatest ts below its own,
    of equal ones that with the greatest record_id, and is ``resolved``,
    ``validator-mismatch``, ``no-validator`` or ``no-earlier-response``; a resolved one
    has that record's id and status and the merged headers.

    A null kind, url or ts resolves nothing and serves no other; null headers are empty.
    Repeated rows come out as often as they are there; other columns are not read,
    whatever their names, and urls and headers of any length are compared whole. No row: no row.
    """
    scratch = Scratch(records.sparkSession, "revisits")
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), F.col("ts").cast("long").alias("ts"), "kind", "status", plain_headers(F.col("headers")).alias("headers")
    )
    rows = scratch.keep(rows, "records")
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))
    placed = rows.filter("canonical is not null and ts is not null")
    keyed = with_pieces(placed, "ts", PIECE_ROWS)
    earlier = Window.partitionBy("canonical", "piece").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    # The greatest struct by (ts, record_id): headers are a map, which has no order, so ids are joined.
    key = F.when(full, F.struct("ts", "record_id"))
    near = keyed.withColumn("near", F.max(key).over(earlier))
    lasts = keyed.filter(full).groupBy("canonical", "piece").agg(F.max(F.struct("ts", "record_id")).alias("last"))
    spans = keyed.select("canonical", "piece").distinct().join(lasts, ["canonical", "piece"], "left")
    before = Window.partitionBy("canonical").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("far", F.max("last").over(before)).select("canonical", "piece", "far").filter("far is not null")
    near = near.join(spans, ["canonical", "piece"], "left").withColumn("found", F.coalesce("near", "far"))
    revisits = near.filter(F.col("kind") == "revisit").withColumn("from_id", F.col("found.record_id")).withColumn("from_ts", F.col("found.ts"))
    # One row for each (canonical, ts, record_id), however often a response is repeated.
    sources = placed.filter(full).groupBy(F.col("canonical"), F.col("ts").alias("from_ts"), F.col("record_id").alias("from_id"))
    sources = sources.agg(F.first("status").alias("old_status"), F.first("headers").alias("old"))
    revisits = _join_sources(scratch.keep(revisits, "revisits"), sources, ["canonical", "from_ts", "from_id"])
    new, old = F.col("headers"), F.col("old")
    pairs = [x for name in ("etag", "last-modified", "warc-payload-digest") for x in (new[name], old[name])]
    resolution = F.when(old.isNull(), "no-earlier-response").otherwise(_verdict(*pairs))
    done = revisits.withColumn("resolution", resolution).select(
        "record_id", "canonical", "kind", "resolution",
        F.when(F.col("resolution") == "resolved", F.col("from_id")).alias("from_id"),
        F.when(F.col("resolution") == "resolved", F.col("old_status")).otherwise(F.col("status")).alias("status"),
        F.when(F.col("resolution") == "resolved", merged_headers(old, new)).otherwise(new).alias("headers"),
    )
    in_join = F.coalesce((F.col("kind") == "revisit") & F.col("canonical").isNotNull() & F.col("ts").isNotNull(), F.lit(False))
    alone = F.when(full, "full").when(F.col("kind") == "revisit", "no-earlier-response").otherwise("other")
    rest = rows.filter(~in_join).select("record_id", "canonical", "kind", alone.alias("resolution"), F.when(full, F.col("record_id")).alias("from_id"), "status", "headers")
    return done.union(rest)


def restored(records: DataFrame) -> DataFrame:
    """``resolve_revisits`` with the ``payload`` of the record that each row takes it from; null where there is none.

    ``records`` also has payload; record ids must be unique for the payload to be certain,
    of repeated ones the greatest payload counts.
    """
    payloads = records.filter("kind = 'response' and status = 200").groupBy(F.col("record_id").alias("from_id")).agg(F.max("payload").alias("payload"))
    found = Scratch(records.sparkSession, "revisits").keep(resolve_revisits(records), "resolved")
    return _join_sources(found, payloads, ["from_id"]).select("record_id", "canonical", "kind", "resolution", "from_id", "status", "headers", "payload")


def crawl_records(pages: DataFrame, step: int = 1_000, later: int = 2_500_000) -> DataFrame:
    """Records of a crawl of ``pages`` (page_id, url, html) and of a second visit to every page, for want of a table of records.

    The second visit asks for another spelling of the url and hears that nothing was
    modified. Its validators are those of the first visit; every seventh page gives a
    weak tag, every eleventh another tag and every thirteenth a date in place of a tag.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), F.lit('"'))
    date = F.concat(F.lit("day "), F.col("page_id").cast("string"))
    first = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * step).alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.length("html").cast("string"), F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
        F.col("html").alias("payload"),
    )
    sent = F.when(F.col("page_id") % 13 == 1, None).when(F.col("page_id") % 11 == 5, F.lit('"other"')).when(F.col("page_id") % 7 == 3, F.concat(F.lit("W/"), tag)).otherwise(tag)
    spelt = F.concat(F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^https?", "HTTPS"), F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_medium=again#x"))
    second = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), spelt.alias("url"), (F.col("page_id") * step + later).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.map_filter(F.create_map(F.lit("ETag"), sent, F.lit("Last-Modified"), date, F.lit("cache-control"), F.lit("no-cache"), F.lit("Content-Length"), F.lit("0"), F.lit("Date"), F.lit("now")), lambda k, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return first.union(second)
