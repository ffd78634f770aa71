"""Public suffixes of hosts: the longest rule that fits, with wildcards and exceptions.

Rules are as the public list writes them: ``co.uk``, ``*.ck`` for every name below ck, and
``!www.ck`` for one that is no suffix after all. A host that no rule fits has its last label.
``suffix_labels`` holds a small table of rules in the expression; ``with_suffix`` joins a
table of any size by equality of label suffixes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules of the public list for common registries.
SUFFIX_RULES = (
    "com", "net", "org", "edu", "gov", "info", "biz", "io", "de", "fr", "es", "eu", "us", "ak.us", "k12.ak.us", "uk", "ac.uk", "co.uk", "gov.uk", "org.uk", "au", "com.au", "br", "com.br", "cn", "com.cn",
    "nz", "co.nz", "jp", "ac.jp", "co.jp", "kyoto.jp", "ide.kyoto.jp", "*.kobe.jp", "!city.kobe.jp", "*.ck", "!www.ck", "*.mm",
)


def host_labels(host: Column) -> Column:
    """Lower-case labels of a host, without the dot of the root."""
    return F.split(F.regexp_replace(F.lower(host), r"\.$", ""), r"\.")


def _tails(labels: Column) -> Column:
    """All label suffixes, the longest first."""
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))


def _parts(rules: Iterable[str]) -> tuple[list[str], list[str], list[str]]:
    """(plain rules, what wildcards stand below, exceptions)."""
    rules = list(rules)
    return [r for r in rules if r[0] not in "*!"], [r[2:] for r in rules if r.startswith("*.")], [r[1:] for r in rules if r[0] == "!"]


def suffix_labels(labels: Column, rules: Iterable[str] = SUFFIX_RULES) -> Column:
    """How many labels of a host are its public suffix."""
    plain, wild, but = (F.array(*map(F.lit, part)).cast("array<string>") for part in _parts(rules))
    size = F.size(labels)

    def found(tails: Column) -> Column:
        fits = lambda t, i: F.array_contains(plain, t) | F.coalesce(F.array_contains(wild, F.get(tails, i + 1)), F.lit(False))
        exception = F.array_max(F.transform(tails, lambda t, i: F.when(F.array_contains(but, t), size - i - 1)))
        longest = F.array_max(F.transform(tails, lambda t, i: F.when(fits(t, i), size - i)))
        return F.coalesce(exception, longest, F.lit(1))

    return F.transform(F.array(_tails(labels)), found)[0]


def registrable_domain(host: Column, rules: Iterable[str] = SUFFIX_RULES) -> Column:
    """The public suffix with one label more; null where a host is no more than a suffix, or null or empty."""
    labels = host_labels(host)
    n = suffix_labels(labels, rules) + 1
    return F.when((F.size(labels) >= n) & (host != "") & ~host.startswith("."), F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def with_suffix(rows: DataFrame, rules: DataFrame, host: str = "host") -> DataFrame:
    """``rows`` with ``suffix``, by a table of ``rule``: each different host meets the rules of its label suffixes by equality."""
    hosts = rows.select(F.col(host).alias("_host")).filter(F.col("_host") != "").distinct().withColumn("_labels", host_labels(F.col("_host")))
    tails = hosts.select("_host", "_labels", F.posexplode(_tails(F.col("_labels"))).alias("_i", "_tail"))
    # A wildcard stands for one label more than what it stands below, an exception for one less.
    kind = F.when(F.col("rule").startswith("!"), "but").when(F.col("rule").startswith("*."), "wild").otherwise("plain")
    keyed = rules.select(kind.alias("_kind"), F.regexp_replace("rule", r"^(!|\*\.)", "").alias("_tail")).distinct()
    hits = tails.join(keyed, "_tail").withColumn("_n", F.size("_labels") - F.col("_i") + F.when(F.col("_kind") == "wild", 1).when(F.col("_kind") == "but", -1).otherwise(0))
    hits = hits.filter(F.col("_n") <= F.size("_labels"))
    best = hits.groupBy("_host").agg(F.max(F.struct((F.col("_kind") == "but").alias("b"), "_n"))["_n"].alias("_n"))
    told = hosts.join(best, "_host", "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    told = told.select("_host", F.array_join(F.slice("_labels", F.size("_labels") - F.col("_n") + 1, F.col("_n")), ".").alias("suffix"))
    return rows.join(told, rows[host] == told["_host"], "left").drop("_host")
