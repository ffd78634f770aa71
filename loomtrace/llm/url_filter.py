"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

Everything is DataFrame expressions. A block of the filter is four 64-bit words; a
key sets eight bits of one block, so a probe reads one row of the filter's table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys for each block of 256 bits: sixteen bits a key, about one false hit in a thousand.
KEYS_PER_BLOCK = 16
#: Blocks that are broadcast at most: 20 MB. A larger filter is joined by shuffling.
BROADCAST_BLOCKS = 500_000
_WORDS = range(4)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and where ``://`` is absent."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, pattern, 2)


def canonical_url(url: Column) -> Column:
    """Host without ``www.``, path without a last slash, and sorted query parameters without tracking ones; null if there is no host."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url.cast("string"), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike("^(utm_[^=]*|ref|fbclid|gclid)(=|$)")))
    shown = F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(host != "", shown)


def _masks(key: Column) -> list[Column]:
    """The bits of a key in the four words of its block."""
    bits = F.xxhash64(key, F.lit(7))
    places = [F.shiftrightunsigned(bits, 8 * j).bitwiseAND(F.lit(255).cast("long")) for j in range(8)]
    one = F.lit(1).cast("long")
    masks = []
    for w in _WORDS:
        mask = F.lit(0).cast("long")
        for place in places:
            inside = F.call_function("shiftleft", one, (place % 64).cast("int"))
            mask = mask.bitwiseOR(F.when((place / 64).cast("int") == w, inside).otherwise(F.lit(0).cast("long")))
        masks.append(mask)
    return masks


class BlockedBloom:
    """A filter over the distinct values of column ``key`` of ``keys``; null keys are not in it."""

    def __init__(self, keys: DataFrame):
        known = keys.filter(F.col("key").isNotNull())
        self.blocks = max(1, -(-known.count() // KEYS_PER_BLOCK))
        masks = known.select(self._block(F.col("key")).alias("block"), *[m.alias(f"m{w}") for w, m in zip(_WORDS, _masks(F.col("key")), strict=True)])
        self.table = masks.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"b{w}") for w in _WORDS])

    def _block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks).cast("long"))

    def possible(self, frame: DataFrame, key: str) -> DataFrame:
        """The rows of ``frame`` whose ``key`` may be in the filter; columns are unchanged."""
        table = F.broadcast(self.table) if self.blocks <= BROADCAST_BLOCKS else self.table
        probed = frame.withColumn("__block", self._block(F.col(key))).join(table.select(F.col("block").alias("__block"), F.struct("b0", "b1", "b2", "b3").alias("__words")), "__block")
        test = F.lit(True)
        for w, mask in zip(_WORDS, _masks(F.col(key)), strict=True):
            test = test & (F.col(f"__words.b{w}").bitwiseAND(mask) == mask)
        return probed.filter(test).select(*[F.col(c) for c in frame.columns])


def _rule_keys(rules: DataFrame) -> DataFrame:
    """(key, size, host_size, verdict) of rules (host, path, verdict)."""
    host = F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.coalesce("path", F.lit(""))
    return rules.filter(F.col("verdict").isin("allow", "block")).select(
        F.concat(host, path).alias("key"), F.length(F.concat(host, path)).alias("size"), F.length(host).alias("host_size"), "verdict",
        F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("path_size"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url; other columns are not read).

    ``rules`` (host, path, verdict) fit their host and its subdomains where the url's
    path starts with theirs; the longest rule that fits decides, and of equal ones
    that block wins. Where no rule fits, a url whose canonical form is in ``listed``
    (column url) is blocked and any other allowed. Keys of a url are the ends of its
    host times the beginnings of its path, of the sizes that rules have.

    Null urls and those without ``://`` have empty host and path, which only a rule
    with both empty fits. Repeated rows and rules change nothing; no row: no row.
    """
    host, path = host_and_path(F.col("url"))
    canonical = canonical_url(F.col("url")) if listed is not None else F.lit(None).cast("string")
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"), canonical.alias("canonical"))
    keys = _rule_keys(rules)
    sizes = keys.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_size").alias("path_sizes")).first()
    wanted = keys.select("key")
    if listed is not None:
        bare = listed.select(canonical_url(F.col("url")).alias("canonical")).filter("canonical is not null").distinct()
        wanted = wanted.union(bare.select(F.concat(F.lit("="), "canonical")))
    bloom = BlockedBloom(wanted.distinct())

    # Each different (host, path) is judged once, however many rows have it.
    targets = urls.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    ends = [F.when(F.size(parts) >= n, F.array_join(F.slice(parts, F.size(parts) - n + 1, F.lit(n)), ".")) for n in sorted(sizes.labels)]
    starts = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(sizes.path_sizes)]
    made = F.array_distinct(F.array_compact(F.array(*[F.concat(e, s) for e in ends for s in starts]))) if ends else F.array().cast("array<string>")
    probes = bloom.possible(targets.select("host", "path", F.explode(made).alias("key")), "key")
    hits = probes.join(keys.select("key", "size", "host_size", "verdict"), "key")
    best = hits.groupBy("host", "path").agg(F.max(F.struct("size", "host_size", "verdict", "key")).alias("best"))
    judged = urls.join(best, ["host", "path"], "left").withColumn("rule", F.col("best.key"))
    otherwise = F.lit("allow")
    if listed is not None:
        possible = bloom.possible(urls.select(F.concat(F.lit("="), "canonical").alias("key")).distinct(), "key")
        found = possible.select(F.substring("key", 2, 1 << 30).alias("canonical")).join(bare, "canonical", "left_semi").withColumn("in_list", F.lit(True))
        judged = judged.join(found, "canonical", "left")
        otherwise = F.when(F.col("in_list"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(F.col("best.verdict"), otherwise).alias("verdict"))
