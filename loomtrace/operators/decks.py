"""Comparison of slide decks and documents in long form.

``slides`` has pair, side, slide (from 1), background, notes; ``shapes`` has pair, side,
slide, shape, kind (table, picture, freeform or another), left, top, width, height, text
(null for a shape that can have none); ``runs`` has pair, side, slide, shape, paragraph, run,
text, level, bullet, bullet_level and the properties of a run; ``table_runs`` has pair,
side, slide, shape, row, col, paragraph, run, bold, italic, underline, color. Both sides
meet by position in one aggregation. Each check can be switched off.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Properties of a run, the check that looks at them and what null stands for.
RUN_CHECKS = {"font": ("examine_font_name", None), "size": ("examine_font_size", None), "bold": ("examine_font_bold", "false"), "italic": ("examine_font_italic", "false"), "strike": ("examine_strike_through", "noStrike")}

#: Checks that are made unless they are switched off, and checks that have to be asked for.
ON = ("examine_number_of_slides", "examine_shape", "examine_text", "examine_indent", "examine_font_name", "examine_font_size", "examine_font_bold", "examine_font_italic", "examine_color_rgb", "examine_font_underline", "examine_strike_through", "examine_alignment", "examine_bullets", "examine_background_color", "examine_note")
OFF = ("examine_title_bottom_position", "examine_table_bottom_position", "examine_right_position", "examine_top_position", "examine_shape_for_shift_size", "examine_image_size", "examine_modify_height")


def near(a: Column, b: Column, tolerance: float = 0.005) -> Column:
    """Two lengths are alike: equal, or apart by no more than a share of the greater; zero is like zero only."""
    return (a == b) | ((a != 0) & (b != 0) & (F.abs(a - b) / F.greatest(F.abs(a), F.abs(b)) <= tolerance))


def same_underline(a: Column, b: Column) -> Column:
    """Both set and equal, or one unset and the other not plainly true."""
    return F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(~F.coalesce(F.coalesce(a, b) == "true", F.lit(False)))


def _both(rows: DataFrame, at: list[str], values: list[str], partitions: int | None = None) -> DataFrame:
    """Both sides at each position; with ``partitions`` all of a pair is sorted in one of so many, and nothing of it is dealt again."""
    if partitions is not None:
        rows = rows.select("pair", "side", *at, *values).repartition(partitions, "pair")
    side = lambda s: F.max(F.when(F.col("side") == s, F.struct(*values)))
    return rows.groupBy("pair", *at).agg(side("result").alias("a"), side("expected").alias("b"))


def _all(rows: DataFrame, *tests: Column) -> DataFrame:
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    test = reduce(lambda x, y: x & y, tests, there)
    return rows.groupBy("pair").agg(F.min(F.coalesce(test, F.lit(False)).cast("double")).alias("score"))


def _placed_tests(on, tolerance: float) -> list[Column]:
    """What shapes at one position have to satisfy by their places, sizes and kinds."""
    alike = {c: near(F.col(f"a.{c}"), F.col(f"b.{c}"), tolerance) for c in ("left", "top", "width", "height")}
    all_alike = reduce(lambda x, y: x & y, alike.values())
    a = lambda c: F.col(f"a.{c}")
    b = lambda c: F.col(f"b.{c}")
    both = lambda kind: a("kind").eqNullSafe(F.lit(kind)) & b("kind").eqNullSafe(F.lit(kind))
    no_text = a("text").isNull() & b("text").isNull()
    same_text = F.coalesce(a("text") == b("text"), F.lit(False))
    lowered = (a("top") > b("top")) & (a("top") >= 3600000)
    tests = {
        "examine_title_bottom_position": F.when(same_text, (a("text") != "Product Comparison") | lowered).otherwise(all_alike),
        "examine_table_bottom_position": F.when((F.col("slide") == 3) & both("table"), lowered).otherwise(all_alike),
        "examine_right_position": F.when((F.col("slide") == 2) & no_text, (a("left") > b("left")) & (a("left") >= 4320000)).otherwise(True),
        "examine_top_position": F.when((F.col("slide") == 2) & both("picture"), (a("top") < b("top")) & (a("top") <= 1980000)).otherwise(True),
        "examine_shape_for_shift_size": all_alike | (same_text & (a("text") == "Elaborate on what you want to discuss.")),
        "examine_shape": all_alike,
        "examine_image_size": F.when(both("picture"), alike["width"] & alike["height"]).otherwise(all_alike),
        "examine_modify_height": F.when(no_text | both("freeform"), alike["height"]).otherwise(all_alike),
    }
    return [test for name, test in tests.items() if on(name)]


def compare_decks(shapes: DataFrame, runs: DataFrame, slides: DataFrame, table_runs: DataFrame, tolerance: float = 0.005, partitions: int | None = None, **options: bool) -> DataFrame:
    """(pair, score): 1 if slides, shapes, paragraphs and runs of two decks agree in all that is looked at (``ON`` by default).

    Without ``examine_number_of_slides`` only slides that both decks have are looked
    at. Runs of tables are compared whatever is switched off, but for their colour. A task sorts
    the rows of its pairs; ``partitions`` says how many such tasks there are, so that a caller can
    let them grow with the table (the session's number by default, whatever the table's size).
    """
    unknown = sorted(set(options) - {*ON, *OFF})
    if unknown:
        raise ValueError(f"no such options: {', '.join(unknown)}")
    on = lambda name: options.get(name, name in ON)
    if not on("examine_number_of_slides"):
        most = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.col("slide"))), F.lit(0))
        common = slides.groupBy("pair").agg(F.least(most("result"), most("expected")).alias("most"))
        shapes, runs, slides, table_runs = (x.join(common, "pair").filter(F.col("slide") <= F.col("most")).drop("most") for x in (shapes, runs, slides, table_runs))
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")
    same_color = F.when(F.col("a.color").isNotNull() & F.col("b.color").isNotNull(), F.col("a.color") == F.col("b.color")).otherwise(True)
    tests = [F.col("a.background").eqNullSafe(F.col("b.background"))] if on("examine_background_color") else []
    if on("examine_note"):
        tests.append(bare(F.col("a.notes")) == bare(F.col("b.notes")))
    shown = _all(_both(slides, ["slide"], ["background", "notes"], partitions), *tests)
    tests = _placed_tests(on, tolerance)
    if on("examine_text"):
        tests.append(bare(F.col("a.text")) == bare(F.col("b.text")))
    placed = _all(_both(shapes, ["slide", "shape"], ["kind", "left", "top", "width", "height", "text"], partitions), *tests)
    value = lambda s, c, d: F.coalesce(F.col(f"{s}.{c}").cast("string"), F.lit(d).cast("string"))
    same = lambda c, d: value("a", c, d).eqNullSafe(value("b", c, d))
    tests = [F.col("a.text").eqNullSafe(F.col("b.text"))] if on("examine_text") else []
    tests += [same(column, default) for column, (check, default) in RUN_CHECKS.items() if on(check)]
    if on("examine_font_underline"):
        tests.append(same_underline(F.col("a.underline"), F.col("b.underline")))
    if on("examine_color_rgb"):
        tests.append(same_color)
    if on("examine_alignment"):
        tests.append(same("alignment", "LEFT"))
    if on("examine_indent"):
        tests.append(same("level", "0"))
    if on("examine_bullets"):
        blank = (bare(F.col("a.text")) == "") & (bare(F.col("b.text")) == "")
        tests.append(blank | (F.col("a.text").eqNullSafe(F.col("b.text")) & same("bullet", "No Bullet") & same("bullet_level", "0")))
    columns = ["text", *RUN_CHECKS, "underline", "color", "alignment", "level", "bullet", "bullet_level"]
    written = _all(_both(runs, ["slide", "shape", "paragraph", "run"], columns, partitions), *tests)
    tests = [same("bold", "false"), same("italic", "false"), same_underline(F.col("a.underline"), F.col("b.underline"))]
    tests += [same_color] if on("examine_color_rgb") else []
    tabled = _all(_both(table_runs, ["slide", "shape", "row", "col", "paragraph", "run"], ["bold", "italic", "underline", "color"], partitions), *tests)
    return reduce(DataFrame.unionByName, [shown, placed, written, tabled]).groupBy("pair").agg(F.min("score").alias("score"))


def paragraphs_agree(paragraphs: DataFrame, values: list[str], shorter: bool = False) -> DataFrame:
    """(pair, score): paragraphs of two documents agree in ``values``; with ``shorter`` only as far as both go."""
    rows = _both(paragraphs, ["paragraph"], values)
    rows = rows.filter(F.col("a").isNotNull() & F.col("b").isNotNull()) if shorter else rows
    return _all(rows, *[F.col(f"a.{v}").eqNullSafe(F.col(f"b.{v}")) for v in values])


def some_run_agrees(runs: DataFrame, flag: str) -> DataFrame:
    """(pair, score): 1 if some run of both sides at one position has the flag."""
    rows = _both(runs, ["paragraph", "run"], [flag])
    hit = F.coalesce(F.col(f"a.{flag}") & F.col(f"b.{flag}"), F.lit(False))
    return rows.groupBy("pair").agg(F.max(hit.cast("double")).alias("score"))


def tab_stops_score(paragraphs: DataFrame) -> DataFrame:
    """(pair, score): 1 less the mean share by which tab stops are off; a differing number of stops counts as wholly off."""
    rows = _both(paragraphs, ["paragraph"], ["stops"])
    off = F.aggregate(F.zip_with("a.stops", "b.stops", lambda x, y: F.least(F.abs(x - y) / F.greatest(F.abs(y), F.lit(1.0)), F.lit(1.0))), F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size("b.stops"), F.lit(1))
    each = F.when(F.size("a.stops") == F.size("b.stops"), off).otherwise(1.0)
    return rows.groupBy("pair").agg((1 - F.avg(each)).alias("score"))
