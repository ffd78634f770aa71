"""Comparison of tables, lists and documents in long form.

A table is rows (key columns, position columns, value). Two sides are joined by
position and the verdict is an aggregate, so that a group of files is one query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_value(a: Column, b: Column, digits: int | None = None) -> Column:
    """Null-safe equality, with half-even rounding of numbers to ``digits``."""
    return F.bround(a, digits).eqNullSafe(F.bround(b, digits)) if digits is not None else a.eqNullSafe(b)


def positional(left: DataFrame, right: DataFrame, by: list[str], at: list[str], value: str, digits: int | None = None, longest: bool = True) -> DataFrame:
    """(*by, compared, differing, score): sides joined by position; ``longest`` counts what only one side has, else it is left out."""
    a = left.select(*by, *at, F.col(value).alias("a"), F.lit(1).alias("in_a"))
    b = right.select(*by, *at, F.col(value).alias("b"), F.lit(1).alias("in_b"))
    joined = a.join(b, [*by, *at], "full" if longest else "inner")
    same = same_value(F.col("a"), F.col("b"), digits) & F.col("in_a").eqNullSafe(F.col("in_b"))
    return joined.groupBy(*by).agg(F.count("*").alias("compared"), F.count_if(~same).alias("differing"), F.min(same.cast("double")).alias("score"))


def differences(left: DataFrame, right: DataFrame, at: list[str], value: str, digits: int | None = None) -> DataFrame:
    """(*at, kind, a, b): positions that are added, removed or changed."""
    a = left.select(*at, F.col(value).alias("a"), F.lit(True).alias("in_a"))
    b = right.select(*at, F.col(value).alias("b"), F.lit(True).alias("in_b"))
    kind = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~same_value(F.col("a"), F.col("b"), digits), "changed")
    return a.join(b, at, "full").withColumn("kind", kind).filter("kind is not null").select(*at, "kind", "a", "b")


def fuzzy_value(text: Column, drop: str = "", strip_left: str = "", strip_right: str = "", ignore_case: bool = False) -> Column:
    """A cell in the normal form of fuzzy rules: characters dropped, then stripped from its ends."""
    if drop:
        text = F.translate(text, drop, "")
    quoted = lambda chars: "[" + "".join("\\" + c if not c.isalnum() and c != " " else c for c in chars) + "]+"
    if strip_left:
        text = F.regexp_replace(text, "^" + quoted(strip_left), "")
    if strip_right:
        text = F.regexp_replace(text, quoted(strip_right) + "$", "")
    return F.lower(text) if ignore_case else text


def bags_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """(equal): whether two frames hold the same rows as often, in any order."""
    columns = left.columns
    marks = left.withColumn("n", F.lit(1)).unionByName(right.withColumn("n", F.lit(-1)))
    sums = marks.groupBy(*columns).agg(F.sum("n").alias("n"))
    return sums.agg(F.coalesce(F.bool_and(F.col("n") == 0), F.lit(True)).alias("equal"))


def sets_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """(equal): whether two frames hold the same rows, however often."""
    return bags_equal(left.distinct(), right.distinct())


def unique_and_complete(rows: DataFrame, initial: DataFrame, key: str) -> DataFrame:
    """(rows, ids, missing, extra, score): no id twice, and the ids of the initial rows all there and no others."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    known = initial.select(key).distinct().withColumn("known", F.lit(True))
    joined = counts.join(known, key, "full")
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("n").alias("ids"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("known").isNull()).alias("extra"),
        F.coalesce(F.bool_and(F.coalesce(F.col("n") == 1, F.lit(False)) & F.col("known").isNotNull()), F.lit(True)).cast("double").alias("score"),
    )


def lists_match(a: Column, b: Column, same) -> Column:
    """Equal sizes, and each element of ``a`` like some element of ``b`` under ``same``: no one-to-one pairing is asked."""
    return (F.size(a) == F.size(b)) & F.forall(a, lambda x: F.exists(b, lambda y: same(x, y)))


#: A range's tiles are a power of this long and wide, the greatest that is no longer or wider than it.
TILE = 8


def _level(length: Column) -> Column:
    """How often a length can be divided by TILE."""
    return F.floor(F.log(float(TILE), length.cast("double")) + 1e-9).cast("int")


def in_ranges(cells: DataFrame, ranges: DataFrame, on: list[str]) -> DataFrame:
    """Cells (row, col) with the ranges (r0, c0, r1, c1) that hold them, by equality of ``on``; each pair once.

    A range lies in at most TILE + 1 tiles of its size each way. Cells look into the one
    tile of each size that ranges of their sheet have, so that a cell meets the ranges
    about it and no others. Ranges without a bound, or that end before they begin, hold nothing.
    """
    sized = ranges.filter("r1 >= r0 and c1 >= c0").withColumn("_lr", _level(F.col("r1") - F.col("r0") + 1)).withColumn("_lc", _level(F.col("c1") - F.col("c0") + 1))
    tile = lambda at, level: F.floor(F.col(at) / F.pow(F.lit(float(TILE)), F.col(level))).cast("long")
    spread = lambda low, high, level: F.explode(F.sequence(tile(low, level), tile(high, level)))
    tiled = sized.withColumn("_tr", spread("r0", "r1", "_lr")).withColumn("_tc", spread("c0", "c1", "_lc"))
    # A few sizes for each sheet.
    sizes = sized.select(*on, "_lr", "_lc").distinct()
    probes = cells.join(sizes, on).withColumn("_tr", tile("row", "_lr")).withColumn("_tc", tile("col", "_lc"))
    keys = [*on, "_lr", "_lc", "_tr", "_tc"]
    return probes.join(tiled, keys).filter("row between r0 and r1 and col between c0 and c1").drop("_lr", "_lc", "_tr", "_tc")


def _spans(low: Column, high: Column) -> Column:
    """[(level, at)]: the fewest stretches of 2 ** level, from a multiple of it on, that make up low to high without overlap."""
    low, high = low.cast("long"), high.cast("long")

    def at_level(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level).cast("long")
        first, end = F.call_function("shiftright", low + size - 1, level), F.call_function("shiftright", high + 1, level)
        odd = lambda x: (first < end) & (x.bitwiseAND(F.lit(1)) == 1)
        span = lambda at: F.struct(level.alias("level"), at.alias("at"))
        return F.array(F.when(odd(first), span(first)), F.when(odd(end), span(end - 1)))

    levels = F.sequence(F.lit(0), (F.log2((high - low + 1).cast("double")) + 1e-9).cast("int"))
    return F.filter(F.flatten(F.transform(levels, at_level)), lambda x: x.isNotNull())


def range_totals(cells: DataFrame, ranges: DataFrame, on: list[str], value: str) -> DataFrame:
    """Cells (row, col) that some range holds, with ``hits``, how many do, and ``last``, the greatest ``value`` of those.

    A range is cut into stretches of powers of two each way, and those that ranges share are
    added up before any cell meets them. A place looks up the stretches of each size about it,
    so the work grows with cells and ranges and not with their pairs. Cells at one place and
    ranges with the same bounds are each taken once.
    """
    bounds = ["r0", "c0", "r1", "c1"]
    once = ranges.filter("r1 >= r0 and c1 >= c0").groupBy(*on, *bounds).agg(F.count("*").alias("hits"), F.max(value).alias("last"))
    rows = once.withColumn("_r", F.explode(_spans(F.col("r0"), F.col("r1"))))
    parts = rows.withColumn("_c", F.explode(_spans(F.col("c0"), F.col("c1"))))
    keys = [*on, "_lr", "_lc", "_tr", "_tc"]
    parts = parts.select(*on, F.col("_r.level").alias("_lr"), F.col("_c.level").alias("_lc"), F.col("_r.at").alias("_tr"), F.col("_c.at").alias("_tc"), "hits", "last")
    parts = parts.groupBy(*keys).agg(F.sum("hits").alias("hits"), F.max("last").alias("last"))
    sizes = parts.select(*on, "_lr", "_lc").distinct()
    tile = lambda at, level: F.call_function("shiftright", F.col(at).cast("long"), F.col(level))
    places = cells.select(*on, "row", "col").distinct()
    probes = places.join(sizes, on).withColumn("_tr", tile("row", "_lr")).withColumn("_tc", tile("col", "_lc"))
    totals = probes.join(parts, keys).groupBy(*on, "row", "col").agg(F.sum("hits").alias("hits"), F.max("last").alias("last"))
    return cells.join(totals, [*on, "row", "col"])


def last_range(cells: DataFrame, ranges: DataFrame, on: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Cells that some range holds with ``values`` of the range that is last in ``order`` among those."""
    names = list(cells.columns)
    ranked = ranges.select(*on, "r0", "c0", "r1", "c1", F.struct(*order, *[v for v in values if v not in order]).alias("_best"))
    best = range_totals(cells.distinct(), ranked, on, "_best")
    return best.select(*names, *[F.col(f"last.`{v}`").alias(v) for v in values])
