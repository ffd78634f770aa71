"""Near-duplicate documents: bottom-k sketches from one hash function, inverted lists, exact Jaccard.

1. One Arrow pass hashes every text's word shingles. Documents with equal sets
   become one class, so that thousands of exact copies cost as much as one text.
2. The k least hash values of a set are its sketch. Linked sets share so many of
   them that the chance of fewer is below 1e-9 (``least_shared``); a class that has
   not that many values in common with others leaves. Retained values are ranked
   from rare to common: partners that share at least t of s values share one of the
   s - t + 1 rarest, and only these enter the inverted lists.
3. In each list the most central class (the hub) is paired with the others: as many
   pairs as members. Overlaps of retained values and the sketch of the union, which
   two sketches give, estimate the likeness and filter pairs; the exact Jaccard
   index of whole sets decides.
4. Lists whose members are then not in one component are joined with themselves if
   they have at most FEW members. Members of longer ones go an exact way: inverted
   lists over their whole sets, where a value that many share ranks behind all that
   few do. Their hubs come first again; lists that are still open are joined with
   themselves under size and positional bounds and the components found so far.
   So no link between components is lost and no group is paired in full.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.batches import map_batches, slices
from loomtrace.llm.components import connected_components
from loomtrace.llm.scratch import Scratch
from loomtrace.llm.shingles import set_key, shingle_sets

#: Retained values of a sketch.
K = 64
#: A chance of losing a link that counts as none.
NEVER = 1e-9
#: Ids that may be broadcast: 16 MB at most. With more, the join shuffles.
BROADCAST_IDS = 1_000_000
#: Members of an open list that are paired with each other; longer lists go by whole sets.
FEW = 48


@lru_cache
def least_shared(k: int, percent: int) -> int:
    """Values that sketches of k share at least when ``percent`` of the union is shared, but for a chance of NEVER.

    The k least values of a union are a sample without replacement; the binomial
    tail bounds the hypergeometric one.
    """
    chance, p = 0.0, percent / 100
    for x in range(k + 1):
        chance += comb(k, x) * p**x * (1 - p) ** (k - x)
        if chance > NEVER:
            return x
    return k


def sketches(docs: DataFrame, words: int = 5, k: int = K) -> DataFrame:
    """(doc_id, text_hash, n_shingles, key_a, key_b, sketch): one row per row of ``docs``; equal sets have equal keys."""

    def scan(batches):
        for rows, data, offsets in slices(batches):
            sets = list(shingle_sets(data, offsets, words))
            keys = [set_key(x) for x in sets]
            sketch = [x[:k] for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([a for a, _ in keys], pa.int64()),
                    pa.array([b for _, b in keys], pa.int64()),
                    _lists(sketch),
                ],
                names=["doc_id", "text_hash", "n_shingles", "key_a", "key_b", "sketch"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), F.col("text").cast("string").alias("text"))
    return map_batches(source, scan, "doc_id long, text_hash long, n_shingles long, key_a long, key_b long, sketch array<long>")


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """(key_a, key_b, whole): the sorted fingerprints of each text under the key of its set."""

    def scan(batches):
        for _, data, offsets in slices(batches):
            sets = list(shingle_sets(data, offsets, words))
            keys = [set_key(x) for x in sets]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()), _lists(sets)], names=["key_a", "key_b", "whole"])

    return map_batches(docs.select("text"), scan, "key_a long, key_b long, whole array<long>")


def by_ids(frame: DataFrame, ids: DataFrame, count: int, how: str) -> DataFrame:
    """A semi or anti join on doc_id; the ids are broadcast only if they are few."""
    return frame.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, "doc_id", how)


def _least_overlap(x: Column, y: Column, percent: int) -> Column:
    """Values that sets of x and y values share at least if they are linked: overlap >= percent * (x + y) / (100 + percent)."""
    return F.ceil(F.lit(percent) * (x + y) / F.lit(100 + percent)).cast("long")


def _like_sized(percent: int) -> Column:
    """Sets whose sizes alone do not rule out a link."""
    return F.lit(percent) * F.greatest("n_a", "n_b") <= F.lit(100) * F.least("n_a", "n_b")


def _sides(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the other columns of ``own`` (node, ...) for both, as <name>_a and <name>_b."""
    for side in ("a", "b"):
        pairs = pairs.join(own.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in own.columns if c != "node"]), side)
    return pairs


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) that the overlap of their retained values and the sketch of their union do not rule out."""
    both = _sides(pairs, classes.select("node", "n", "sketch"))
    shared = F.array_intersect("sketch_a", "sketch_b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    seen = F.size(F.array_intersect(union, shared))
    # A union of fewer than k values is known in full.
    enough = F.when(F.size(union) == k, F.lit(least_shared(k, percent))).otherwise(F.ceil(F.lit(percent) * F.size(union) / 100))
    return both.filter(_like_sized(percent) & (seen >= enough)).select("a", "b")


def _verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked."""
    both = _sides(pairs, whole)
    shared = F.size(F.array_intersect("whole_a", "whole_b"))
    return both.filter(F.lit(100) * shared >= F.lit(percent) * (F.size("whole_a") + F.size("whole_b") - shared)).select("a", "b")


def _grouped(docs: DataFrame, words: int, percent: int, k: int, scratch: Scratch) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, alone) for every row; ``alone`` rows link with nothing."""
    sets = scratch.keep(sketches(docs, words, k), "sketches")
    own = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = own.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    # Two classes may have the same least doc_id where rows share one, so each has a number of its own.
    classes = scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    lists = scratch.keep(_sketch_lists(classes, percent, k), "lists")
    hubs = lists.groupBy("value").agg(F.count("*").alias("members"), F.min(F.struct("unique", "node", "n", "rest", "least")).alias("hub")).filter("members > 1")
    hubs = scratch.keep(hubs, "hubs")
    key = ["key_a", "key_b"]
    component = classes.select(*key, F.col("rep").alias("component_id"))
    if not hubs.isEmpty():
        labels = _links(docs, classes, lists, hubs, words, percent, k, scratch)
        linked = scratch.keep(classes.select("node", *key, "rep").join(labels, "node"), "linked")
        least = linked.groupBy("label").agg(F.min("rep").alias("least_id"))
        linked = linked.join(least, "label").select(*key, "least_id")
        component = component.join(linked, key, "left").select(*key, F.coalesce("least_id", "component_id").alias("component_id"))
    component = scratch.keep(component, "components")
    scratch.only(sets, component)
    joined = sets.select("doc_id", "text_hash", "n_shingles", *key).join(component, key, "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return joined.select("doc_id", "text_hash", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), alone.alias("alone"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are not read).

    Documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of
    ``words``-word shingles (A-Z lower-cased, words apart by white space); with fewer
    words the whole sequence is the one shingle. ``component_id`` is the least doc_id
    that links reach and ``kept`` marks the document that has it.

    Null or empty texts, and texts without a word, have no shingle and link with
    nothing. Rows that share a doc_id are judged each by its own text.
    A row with a null doc_id links with nothing, has a null component and is kept.
    Very long texts are read whole, one at a time. No row: no row.
    """
    found = _grouped(docs, words, percent, k, Scratch(docs.sparkSession, "near-duplicates"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _sketch_lists(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, node, n, unique, least, rest): the rarest retained values of each class, in which a partner must meet it.

    ``least`` is the overlap of retained values that a partner has at least. A set whose
    partners' sketches cannot be cut off has an exact bound; the others' is that of
    ``least_shared``. ``unique`` values no other class retains; they rank first and
    need no list. ``rest`` counts the shared ones from this value on.
    """
    retained = classes.select("node", "n", F.explode("sketch").alias("value"))
    often = retained.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
    ranked = retained.join(often, "value").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("common"))
    exact = F.ceil(F.lit(percent) * F.col("n") / F.lit(100)).cast("long")
    least = F.when(F.col("n") * 100 <= k * percent, exact).otherwise(F.least(exact, F.lit(least_shared(k, percent)).cast("long")))
    ranked = ranked.withColumn("least", least).withColumn("held", F.size("common").cast("long"))
    ranked = ranked.withColumn("unique", F.least("n", F.lit(k)) - F.col("held")).filter("held >= least")
    prefix = F.slice("common", F.lit(1), (F.col("held") - F.col("least") + 1).cast("int"))
    lists = ranked.select("node", "n", "unique", "least", "held", F.posexplode(prefix).alias("at", "entry"))
    return lists.select(F.col("entry.value").alias("value"), "node", "n", "unique", "least", (F.col("held") - F.col("at")).alias("rest"))


def _whole_lists(whole: DataFrame, percent: int) -> DataFrame:
    """(value, node, n, unique, rest): the rarest values of whole sets, in which a partner must meet them."""
    values = whole.select("node", F.size("whole").cast("long").alias("n"), F.explode("whole").alias("value"))
    often = values.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
    ranked = values.join(often, "value").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("common"))
    ranked = ranked.withColumn("held", F.size("common").cast("long"))
    prefix = F.col("held") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100)).cast("long") + 1
    lists = ranked.withColumn("prefix", prefix).filter("prefix > 0").select("node", "n", "held", F.posexplode(F.slice("common", F.lit(1), F.col("prefix").cast("int"))).alias("at", "entry"))
    return lists.select(F.col("entry.value").alias("value"), "node", "n", (F.col("n") - F.col("held")).alias("unique"), (F.col("held") - F.col("at")).alias("rest"))


def _stars(lists: DataFrame, hubs: DataFrame, least: Column, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of each member with its list's hub, which ``hubs`` has as a struct, that sizes and positions allow.

    ``least`` is the overlap that a pair must have, of the columns ``least`` or n and hub.n.
    """
    met = lists.join(hubs.select("value", "hub"), "value").filter(F.col("node") != F.col("hub.node"))
    met = met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"), F.col("n").alias("n_a"), F.col("hub.n").alias("n_b"), F.least("rest", "hub.rest").alias("rest"), least.alias("least"))
    return met.filter(_like_sized(percent) & (F.col("rest") >= F.col("least"))).select("a", "b").distinct()


def _with_labels(lists: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists with the component of each member, and (value, members) of those that lie in more than one."""
    labelled = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = labelled.groupBy("value").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
    return labelled, spread.filter("low < high").select("value", "members")


def _meet(x: DataFrame, y: DataFrame, on: list[str], names: tuple[str, ...], condition: Column) -> DataFrame:
    """Pairs (a, b), a < b, of members of different components that meet in a list."""
    x = x.select(*on, *[F.col(c).alias(f"{c}_a") for c in names])
    y = y.select(*on, *[F.col(c).alias(f"{c}_b") for c in names])
    met = x.join(y, on).filter((F.col("label_a") != F.col("label_b")) & condition)
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _links(docs: DataFrame, classes: DataFrame, lists: DataFrame, hubs: DataFrame, words: int, percent: int, k: int, scratch: Scratch) -> DataFrame:
    """(node, label) of the classes that are linked with another."""
    # Stars: the hub of a list is the member with the fewest values of its own.
    stars = _stars(lists, hubs, F.greatest("least", "hub.least"), percent)
    stars = scratch.keep(_estimated(stars, classes, percent, k), "stars")

    # Whole sets of the classes that share a list; each is read from the row of its least doc_id.
    members = lists.join(hubs.select("value"), "value", "left_semi").select("node").distinct()
    chosen = scratch.keep(classes.join(members, "node", "left_semi").select("node", "key_a", "key_b", "rep"), "chosen")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = chosen.select(F.col("rep").alias("doc_id")).distinct()
    whole = _whole_sets(by_ids(texts, ids, chosen.count(), "left_semi"), words)
    whole = scratch.keep(whole.join(chosen, ["key_a", "key_b"]).select("node", "whole"), "whole")
    if not whole.groupBy("node").count().filter("count > 1").isEmpty():  # rows are repeated
        whole = scratch.keep(whole.groupBy("node").agg(F.first("whole").alias("whole")), "whole")
    edges = scratch.keep(_verified(stars, whole, percent), "links")
    labels = connected_components(edges, scratch)

    # Short lists that are not in one component yet.
    labelled, spread = _with_labels(lists, labels)
    labelled, spread = scratch.keep(labelled, "labelled"), scratch.keep(spread, "open")
    few = labelled.join(spread.filter(F.col("members") <= FEW).select("value"), "value", "left_semi")
    names = ("node", "n", "rest", "least", "label")
    possible = (F.col("node_a") < F.col("node_b")) & _like_sized(percent) & (F.least("rest_a", "rest_b") >= F.greatest("least_a", "least_b"))
    pairs = _meet(few, few, ["value"], names, possible).join(stars, ["a", "b"], "left_anti")
    further = scratch.keep(_verified(_estimated(pairs, classes, percent, k), whole, percent), "links")
    if not further.isEmpty():
        edges = scratch.keep(edges.union(further), "edges")
        labels = connected_components(edges, scratch)

    # Members of long ones, by whole sets: first with the hubs of their lists.
    many = labelled.join(spread.filter(F.col("members") > FEW).select("value"), "value", "left_semi").select("node").distinct()
    many = scratch.keep(many, "many")
    if many.isEmpty():
        return labels
    lists = scratch.keep(_whole_lists(whole.join(many, "node", "left_semi"), percent), "whole-lists")
    labelled, spread = _with_labels(lists, labels)
    # The hub is of the component that the list's most central member is in; its members need not meet it.
    labelled = scratch.keep(labelled.join(spread.select("value"), "value", "left_semi"), "whole-open")
    hubs = labelled.groupBy("value").agg(F.min(F.struct("unique", "node", "n", "rest", "label")).alias("hub"))
    apart = labelled.join(hubs, "value").filter(F.col("label") != F.col("hub.label")).select("value", "node", "n", "rest")
    more = _stars(apart, hubs, _least_overlap(F.col("n"), F.col("hub.n"), percent), percent).join(stars, ["a", "b"], "left_anti")
    more = scratch.keep(_estimated(more, classes, percent, k), "stars")
    further = scratch.keep(_verified(more, whole, percent), "links")
    if not further.isEmpty():
        edges = scratch.keep(edges.union(further), "edges")
        labels = connected_components(edges, scratch)

    # Then with each other where lists are still open. The smaller set of a pair has a value in common
    # with the larger one while at least as many are left as sets of its size must share.
    labelled, spread = _with_labels(lists, labels)
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)))).cast("long")
    labelled = scratch.keep(labelled.withColumn("size", step).join(spread.select("value"), "value", "left_semi"), "whole-open")
    smaller = labelled.filter(F.col("rest") >= _least_overlap(F.col("n"), F.col("n"), percent))
    smaller = smaller.withColumn("size", F.explode(F.array(F.col("size"), F.col("size") + 1)))
    possible = (F.struct("n_a", "node_a") < F.struct("n_b", "node_b")) & _like_sized(percent) & (F.least("rest_a", "rest_b") >= _least_overlap(F.col("n_a"), F.col("n_b"), percent))
    pairs = _meet(smaller, labelled, ["value", "size"], ("node", "n", "rest", "label"), possible)
    pairs = pairs.join(stars.union(more), ["a", "b"], "left_anti")
    further = scratch.keep(_verified(_estimated(pairs, classes, percent, k), whole, percent), "links")
    return labels if further.isEmpty() else connected_components(edges.union(further), scratch)


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that are not the kept one of their group; its columns are unchanged.

    Rows are judged by doc_id and text, so rows that share a doc_id go or stay each by
    its own text. Rows of a group that carry its least doc_id stay, as do rows without a
    word and rows with a null doc_id. What goes is broadcast if it is at most
    BROADCAST_IDS rows, else the join shuffles.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates-gone")
    found = _grouped(docs, words, percent, K, scratch).filter("not alone and doc_id != component_id")
    gone = scratch.keep(found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "gone")
    scratch.only(gone)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id").cast("long").alias("__id"), _text_hash().alias("__hash"))
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, ["__id", "__hash"], "left_anti").select("__row.*")
