"""Rules over workbooks in long form: each is an aggregate over cells or properties of a pair of files.

``cells`` has pair (the task), side (``result`` or ``expected``), sheet, row, col, text
and number; ``properties`` has pair, side, sheet, kind (chart, pivot_table, filter,
freeze, zoom, row_props, col_props, style, sparkline), key and value. A rule gives
(pair, score); all rules of a task must hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtrace.functions.rules import cell_range, rule
from loomtrace.functions.text import indel_ratio
from loomtrace.operators.compare import fuzzy_value, in_ranges

#: Rule types that compare all properties of one kind.
PROPERTY_RULES = ("sparkline", "chart", "style", "freeze", "row_props", "col_props", "filter", "pivot_table")


def _sides(rows: DataFrame, at: list[str], values: list[str]) -> DataFrame:
    """Both sides in one row of each position, by one aggregation instead of a join."""
    side = lambda s: F.max(F.when(F.col("side") == s, F.struct(F.lit(1).alias("there"), *values)))
    return rows.groupBy("pair", *at).agg(side("result").alias("a"), side("expected").alias("b"))


def _verdict(rows: DataFrame, same: Column) -> DataFrame:
    return rows.groupBy("pair").agg(F.min(F.coalesce(same, F.lit(False)).cast("double")).alias("score"))


def _there(a: str = "a", b: str = "b") -> Column:
    return F.col(a).isNotNull() & F.col(b).isNotNull()


def _inside(ranges: list[str] | None) -> Column:
    if not ranges:
        return F.lit(True)
    boxes = [cell_range(x) for x in ranges]
    return reduce(lambda x, y: x | y, [F.col("row").between(r0, r1) & F.col("col").between(c0, c1) for r0, c0, r1, c1 in boxes])


def sheet_names(cells: DataFrame) -> DataFrame:
    """The same sheets on both sides."""
    return _verdict(_sides(cells.withColumn("one", F.lit(1)), ["sheet"], ["one"]), _there())


def sheet_data(cells: DataFrame, sheet: str, precision: int = 4) -> DataFrame:
    """The same cells: numbers to ``precision`` places, half to even, and other cells by text."""
    number = lambda s: F.bround(F.col(f"{s}.number"), precision)
    text = lambda s: F.when(F.col(f"{s}.number").isNull(), F.col(f"{s}.text"))
    rows = _sides(cells.filter(F.col("sheet") == sheet), ["row", "col"], ["text", "number"])
    return _verdict(rows, _there() & number("a").eqNullSafe(number("b")) & text("a").eqNullSafe(text("b")))


def sheet_print(cells: DataFrame, sheet: str, ignore_case: bool = False) -> DataFrame:
    """The same texts of cells, as they would be printed."""
    low = F.lower if ignore_case else (lambda x: x)
    return _verdict(_sides(cells.filter(F.col("sheet") == sheet), ["row", "col"], ["text"]), _there() & low(F.col("a.text")).eqNullSafe(low(F.col("b.text"))))


def sheet_fuzzy(cells: DataFrame, sheet: str, ranges: list[str], how: str = "exact_match", threshold: float = 85.0, **form) -> DataFrame:
    """Cells in ranges alike in a normal form: includes, included_by, fuzzy_match or exact_match."""
    rows = _sides(cells.filter((F.col("sheet") == sheet) & _inside(ranges)), ["row", "col"], ["text"])
    a, b = (fuzzy_value(F.coalesce(F.col(f"{s}.text"), F.lit("")), **form) for s in ("a", "b"))
    if how == "fuzzy_match":
        rows = rows.withColumn("x", a).withColumn("y", b).withColumn("likeness", indel_ratio("x", "y"))
        return _verdict(rows, F.col("likeness") * 100 >= threshold)
    return _verdict(rows, {"includes": a.contains(b), "included_by": b.contains(a), "exact_match": a == b}[how])


def property_equal(properties: DataFrame, kind: str, sheet: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """The same properties of a kind on both sides, by key; ``fields`` limits what is looked at."""
    rows = properties.filter(F.col("kind") == kind)
    rows = rows.filter(F.col("sheet") == sheet) if sheet else rows
    rows = rows.filter(F.element_at(F.split("key", r"\."), -1).isin(*fields)) if fields else rows
    return _verdict(_sides(rows, ["key"], ["value"]), _there() & F.col("a.value").eqNullSafe(F.col("b.value")))


def zoom(properties: DataFrame, method: str, ref) -> DataFrame:
    """The zoom of the result satisfies a rule; 100 where none is set."""
    value = F.coalesce(F.max(F.when((F.col("side") == "result") & (F.col("kind") == "zoom"), F.col("value"))), F.lit("100"))
    return properties.groupBy("pair").agg(value.alias("zoom")).select("pair", rule(F.col("zoom"), method, ref).cast("double").alias("score"))


def check_cell(cells: DataFrame, sheet: str, coordinate: str, method: str, ref) -> DataFrame:
    """One cell of the result satisfies a rule; a missing one has the empty text."""
    row, col, _, _ = cell_range(coordinate)
    here = (F.col("side") == "result") & (F.col("sheet") == sheet) & (F.col("row") == row) & (F.col("col") == col)
    found = cells.groupBy("pair").agg(F.coalesce(F.max(F.when(here, F.col("text"))), F.lit("")).alias("text"))
    return found.select("pair", rule(F.col("text"), method, ref).cast("double").alias("score"))


def data_validation(validators: DataFrame, wanted: list[dict[str, tuple[str, object]]]) -> DataFrame:
    """At least as many validators (pair, fields: a map) as property sets, and each satisfies one of them."""
    fits = reduce(lambda x, y: x | y, [reduce(lambda p, q: p & q, [rule(F.try_element_at("fields", F.lit(k)), *r) for k, r in each.items()]) for each in wanted])
    return validators.groupBy("pair").agg(((F.count("*") >= len(wanted)) & F.bool_and(fits)).cast("double").alias("score"))


def apply_rules(cells: DataFrame, properties: DataFrame, rules: list[dict], validators: DataFrame | None = None) -> DataFrame:
    """(pair, score): 1 if every rule of the list holds for the pair; a pair that a rule finds nothing of fails it not.

    Rules of type ``data_validation`` (``wanted``) look at ``validators``; a pair without any fails them.
    """
    verdicts, by_cell = [], []
    for r in rules:
        kind, rest = r["type"], {k: v for k, v in r.items() if k != "type"}
        if kind in CELL_RULES and rest.get("how") != "fuzzy_match":
            by_cell.append((kind, rest))
        elif kind == "sheet_fuzzy":
            verdicts.append(sheet_fuzzy(cells, **rest))
        elif kind in PROPERTY_RULES:
            verdicts.append(property_equal(properties, kind, **rest))
        elif kind == "zoom":
            verdicts.append(zoom(properties, **rest))
        elif kind == "data_validation":
            if validators is None:
                raise ValueError("data_validation needs validators")
            found = cells.select("pair").distinct().join(data_validation(validators, **rest), "pair", "left")
            verdicts.append(found.select("pair", F.coalesce("score", F.lit(0.0)).alias("score")))
        else:
            raise ValueError(f"no such rule: {kind}")
    if by_cell:
        verdicts.append(_cell_rules(cells, by_cell))
    return reduce(DataFrame.unionByName, verdicts).groupBy("pair").agg(F.min("score").alias("score"))


#: Rules that look at cells; all of a list are told from one grouping of them.
CELL_RULES = ("sheet_name", "sheet_data", "sheet_print", "sheet_fuzzy", "check_cell")


def _same_cell(kind: str, precision: int = 4, ignore_case: bool = False, how: str = "exact_match", **form) -> Column:
    """Whether both sides of a cell agree under a rule."""
    if kind == "sheet_data":
        number = lambda s: F.bround(F.col(f"{s}.number"), precision)
        text = lambda s: F.when(F.col(f"{s}.number").isNull(), F.col(f"{s}.text"))
        return _there() & number("a").eqNullSafe(number("b")) & text("a").eqNullSafe(text("b"))
    if kind == "sheet_print":
        low = F.lower if ignore_case else (lambda x: x)
        return _there() & low(F.col("a.text")).eqNullSafe(low(F.col("b.text")))
    a, b = (fuzzy_value(F.coalesce(F.col(f"{s}.text"), F.lit("")), ignore_case=ignore_case, **form) for s in ("a", "b"))
    return {"includes": a.contains(b), "included_by": b.contains(a), "exact_match": a == b}[how]


def _cell_rules(cells: DataFrame, rules: list[tuple[str, dict]]) -> DataFrame:
    """(pair, score) of rules over cells: cells are grouped by place, then by sheet, then by pair."""
    placed = _sides(cells, ["sheet", "row", "col"], ["text", "number"])
    told, last = [], []
    for i, (kind, options) in enumerate(rules):
        if kind in ("sheet_data", "sheet_print", "sheet_fuzzy"):
            rest = {k: v for k, v in options.items() if k not in ("sheet", "ranges")}
            here = (F.col("sheet") == options["sheet"]) & _inside(options.get("ranges"))
            told.append(F.min(F.when(here, F.coalesce(_same_cell(kind, **rest), F.lit(False)).cast("double"))).alias(f"s{i}"))
            last.append(F.min(f"s{i}"))
        elif kind == "check_cell":
            row, col, _, _ = cell_range(options["coordinate"])
            here = (F.col("sheet") == options["sheet"]) & (F.col("row") == row) & (F.col("col") == col)
            told.append(F.max(F.when(here, F.col("a.text"))).alias(f"s{i}"))
            last.append(rule(F.coalesce(F.max(f"s{i}"), F.lit("")), options["method"], options["ref"]).cast("double"))
        else:
            told.append((F.max(F.col("a").isNotNull()) & F.max(F.col("b").isNotNull())).cast("double").alias(f"s{i}"))
            last.append(F.min(f"s{i}"))
    sheets = placed.groupBy("pair", "sheet").agg(*told)
    scores = sheets.groupBy("pair").agg(*[c.alias(f"r{i}") for i, c in enumerate(last)])
    worst = F.array_min(F.array(*[F.col(f"r{i}") for i in range(len(rules))]))
    return scores.select("pair", worst.alias("score")).filter("score is not null")


def conditional_styles(cells: DataFrame, formats: DataFrame) -> DataFrame:
    """Cells with the style that holds: that of the last active format (sheet, r0, c0, r1, c1, priority, low, high, style) whose range and bounds they lie in, else their own."""
    keys = ["pair", "side", "sheet", "row", "col"]
    hits = in_ranges(cells.select(*keys, "number"), formats.withColumnRenamed("style", "format_style"), ["sheet"])
    hits = hits.filter(F.col("number").between(F.least("low", "high"), F.greatest("low", "high")))
    best = hits.groupBy(*keys).agg(F.max_by("format_style", "priority").alias("format_style"))
    own = cells.groupBy(*keys).agg(F.first("style").alias("own_style"))
    return own.join(best, keys, "left").select(*keys, F.coalesce("format_style", "own_style").alias("style"))
