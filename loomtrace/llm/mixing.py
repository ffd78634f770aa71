"""Mixing sources to target weights: hierarchical budgets over domain, language and source.

A token budget goes down the tree. Each node shares what it gets among its children
by weight; a child that has less than its share gives the rest back to its siblings,
and because a node never gets more than its subtree holds, only what all siblings
lack goes to the level above. Each leaf then takes whole seeded epochs of its
documents and a token-prefix of one more. Everything is DataFrame expressions.

A prefix of a leaf's order is found in two steps: the leaf's documents fall into
buckets by the beginning of their order key, whose token sums are few; only the
documents of the one bucket in which the prefix ends are sorted. So a leaf that has
a third of all rows is no larger a task than another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.scratch import Scratch

LEVELS = ("domain", "lang", "source")
#: Hex digits of the order key that name a bucket: 4,096 buckets for each leaf.
BUCKET_DIGITS = 3
#: Leaves whose plan is broadcast at most: 10 MB. With more, the join shuffles.
BROADCAST_LEAVES = 50_000
NAMELESS = "(none)"


def count_tokens(text: Column) -> Column:
    """Words of a text: runs of anything but space and 0x09 to 0x0D; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _whole(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def _share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (*parent, name, cap, weight, budget of the parent) with ``got``: the parent's budget shared by weight, no more than cap each.

    In the order of cap / weight, a node is full if what it and the fuller ones hold
    is within their budget; the others share what is left, and whole tokens that
    rounding leaves go to the first of them.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy("ratio", name)
    nodes = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(0.0))
    before = F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cap")
    onward = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nodes = nodes.withColumn("full", _whole("cap") * _whole(onward) <= _whole(F.col("budget") - before) * _whole("weight"))
    held = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family)
    weights = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(family)
    nodes = nodes.withColumn("left_over", F.col("budget") - held).withColumn("weights", weights)
    part = F.expr("cast(cast(weight as decimal(19,0)) * cast(left_over as decimal(19,0)) div weights as long)")
    nodes = nodes.withColumn("part", F.when(F.col("full"), F.col("cap")).otherwise(part))
    spare = F.col("budget") - F.sum("part").over(family)
    nodes = nodes.withColumn("rank", F.sum(F.when(F.col("full"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    got = F.col("part") + F.when(~F.col("full") & (F.col("rank") <= spare), 1).otherwise(0)
    return nodes.withColumn("spare_", spare).withColumn("got", got.cast("long")).drop("ratio", "full", "left_over", "weights", "part", "rank", "spare_")


def budgets(leaves: DataFrame, weights: DataFrame, tokens: int, epochs: int) -> DataFrame:
    """(domain, lang, source, supply, budget) of each leaf of ``leaves`` (domain, lang, source, supply).

    ``weights`` has domain, lang, source and weight, a whole number; null names stand
    for the node above. A node without a row weighs 1, one of weight 0 gets nothing.
    The budgets add up to ``tokens``, or to all that ``epochs`` passes over nodes of
    some weight can give.
    """
    weights = weights.groupBy(*LEVELS).agg(F.max("weight").cast("long").alias("weight"))
    below = leaves.select(*LEVELS, "supply", (F.col("supply") * epochs).alias("cap"))
    for depth in range(1, 4):  # weights come on, and what lies under weight 0 holds nothing
        own = weights.filter(F.col(LEVELS[depth - 1]).isNotNull())
        own = own.filter(F.col(LEVELS[depth]).isNull()) if depth < 3 else own
        own = own.select(*LEVELS[:depth], F.col("weight").alias("w"))
        below = below.join(own, list(LEVELS[:depth]), "left").withColumn(f"weight{depth}", F.coalesce("w", F.lit(1).cast("long"))).drop("w")
    below = below.withColumn("cap", F.when((F.col("weight1") > 0) & (F.col("weight2") > 0) & (F.col("weight3") > 0), F.col("cap")).otherwise(0))
    total = min(tokens, below.agg(F.sum("cap")).first()[0] or 0)
    parent = None
    for depth in range(1, 4):
        names = list(LEVELS[:depth])
        children = below.groupBy(*names).agg(F.sum("cap").alias("cap"), F.first(f"weight{depth}").alias("weight"))
        children = children.join(parent, names[:-1]) if parent is not None else children.withColumn("budget", F.lit(total).cast("long"))
        parent = _share_out(children, names[:-1], names[-1]).select(*names, F.col("got").alias("budget"))
    return leaves.select(*LEVELS, "supply").join(parent, list(LEVELS))


def _order_key(seed: int, epoch: Column) -> Column:
    """Where a row stands in an epoch of its leaf: by its id and its text, so that rows without an id, or of one, are not all in one place."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("digest")).cast("binary"))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")).alias("digest")


def _plan(rows: DataFrame, weights: DataFrame, tokens: int | None, share: float, seed: int, epochs: int, scratch: Scratch) -> DataFrame:
    """(domain, lang, source, budget, whole, rest, cut, before): whole epochs of a leaf, and where the prefix of ``rest`` tokens ends."""
    leaves = scratch.keep(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply")), "leaves")
    if tokens is None:
        tokens = int((leaves.agg(F.sum("supply")).first()[0] or 0) * share)
    plan = scratch.keep(budgets(leaves, weights, tokens, epochs), "budgets")
    plan = plan.withColumn("whole", F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(F.lit(0)).cast("int"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply"))
    near = _with_plan(rows, plan.filter("rest > 0"))
    near = near.withColumn("bucket", F.substring(_order_key(seed, F.col("whole")), 1, BUCKET_DIGITS))
    sums = near.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("tokens").alias("held"))
    running = F.sum("held").over(Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cuts = sums.withColumn("upto", running).filter((F.col("upto") - F.col("held") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
    cuts = cuts.select(*LEVELS, F.col("bucket").alias("cut"), (F.col("upto") - F.col("held")).alias("before"))
    return scratch.keep(plan.join(cuts, list(LEVELS), "left"), "plan")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` joined to their leaf's plan, which is broadcast only if the leaves are few."""
    return rows.join(F.broadcast(plan) if plan.count() <= BROADCAST_LEAVES else plan, list(LEVELS))


def _named(docs: DataFrame, domain: Column) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit(NAMELESS)).alias(n) for c, n in ((domain, "domain"), (docs["lang"], "lang"), (docs["source"], "source"))]


def _prefix(rows: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the last, partial epoch: those of buckets before the cut, whole, and those of the cut with ``taken`` tokens each."""
    key = _order_key(seed, F.col("whole"))
    rows = rows.filter("rest > 0").withColumn("order_key", key)
    bucket = F.substring("order_key", 1, BUCKET_DIGITS)
    order = Window.partitionBy(*LEVELS).orderBy("order_key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_cut = rows.filter(bucket == F.col("cut")).withColumn("start", F.col("before") + F.sum("tokens").over(order) - F.col("tokens"))
    at_cut = at_cut.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("tokens"), F.col("rest") - F.col("start"))))
    return rows.filter(bucket < F.col("cut")), at_cut.filter("taken > 0")


def mix(docs: DataFrame, domain: Column, weights: DataFrame, tokens: int | None = None, share: float = 0.5, seed: int = 0, epochs: int = 4) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, n_tokens, taken): one row for each time that a document of ``docs`` is taken.

    ``tokens`` is the budget, else ``share`` of all tokens. ``taken`` is less than
    ``n_tokens`` only for the document in which a leaf's prefix ends; a leaf's
    ``taken`` add up to its budget. Documents without a token are never taken. Null
    names count as ``(none)``, null ids as one more id; rows that are alike in id and
    text are taken in any order. Very long texts count with all their tokens; other
    columns are not read, whatever their names. No row: no row.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_named(docs, domain), count_tokens(docs["text"]).alias("tokens"), _digest(docs["text"]))
    rows = scratch.keep(rows, "tokens")
    plan = _plan(rows, weights, tokens, share, seed, epochs, scratch)
    scratch.only(rows, plan)
    planned = _with_plan(rows, plan).filter("tokens > 0")
    again = planned.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1))).withColumn("taken", F.col("tokens"))
    inside, at_cut = _prefix(planned, seed)
    last = inside.withColumn("taken", F.col("tokens")).unionByName(at_cut.drop("start")).withColumn("epoch", F.col("whole"))
    columns = ["doc_id", *LEVELS, "epoch", F.col("tokens").alias("n_tokens"), F.col("taken").cast("long").alias("taken")]
    return again.select(*columns).union(last.select(*columns))


def mixed_documents(docs: DataFrame, domain: Column, weights: DataFrame, tokens: int | None = None, share: float = 0.5, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` that a mix of one epoch takes; columns are unchanged. Texts move only where a leaf's prefix ends."""
    scratch = Scratch(docs.sparkSession, "mixing")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_named(docs, domain), count_tokens(docs["text"]).alias("tokens"), _digest(docs["text"]), own)
    plan = _plan(scratch.keep(rows.drop("row"), "tokens"), weights, tokens, share, seed, 1, scratch)
    scratch.only(plan)
    planned = _with_plan(rows, plan).filter("tokens > 0")
    inside, at_cut = _prefix(planned, seed)
    return planned.filter("whole > 0").select("row.*").union(inside.select("row.*")).union(at_cut.select("row.*"))
