"""Sizes and places in pictures: resizing to a grid of patches and changes of coordinate systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_factor(number: Column, factor: int, how: str = "round") -> Column:
    """The multiple of a factor nearest to a number (half to even), or the one above or below."""
    part = number.cast("double") / factor
    return ({"round": F.rint, "ceil": F.ceil, "floor": F.floor}[how](part) * factor).cast("long")


def resized(height: Column, width: Column, factor: int = 28, least: int = 3_136, most: int = 1_003_520, longest: int = 8_192) -> Column:
    """A struct (height, width) of multiples of ``factor`` with ``least`` to ``most`` pixels and the same proportions.

    Null for sides below 2 and for proportions beyond 200.
    """
    long_side, short_side = F.greatest(height, width).cast("double"), F.least(height, width)
    beta = F.greatest(long_side / longest, F.lit(1.0))
    h, w = (F.when(long_side > longest, F.floor(x / beta)).otherwise(x).cast("double") for x in (height, width))
    h0, w0 = to_factor(h, factor), to_factor(w, factor)
    down, up = F.sqrt(h * w / most), F.sqrt(F.lit(float(least)) / (h * w))
    pick = lambda x, x0: F.when(h0 * w0 > most, to_factor(x / down, factor, "floor")).when(h0 * w0 < least, to_factor(x * up, factor, "ceil")).otherwise(x0)
    fits = (short_side >= 2) & (long_side / short_side <= 200)
    return F.when(fits, F.struct(pick(h, h0).alias("height"), pick(w, w0).alias("width")))


def picture_tokens(height: Column, width: Column, least: int = 1, most: int = 12_800, merge: int = 2, patch: int = 14) -> Column:
    """A struct (height, width, seq_len) for a budget of tokens."""
    unit = patch * patch * merge * merge
    size = resized(height, width, merge * patch, unit * least, unit * most, 50_000)
    return F.struct(size["height"].alias("height"), size["width"].alias("width"), (F.floor(size["height"] * size["width"] / unit) + 2).alias("seq_len"))


#: Units of the coordinate systems besides pixels: a grid to 999, shares of 1, and percent.
SYSTEMS = ("abs_origin", "abs_resized", "qwen-vl", "rel", "molmo")


def converted(box: Column, size: Column, source: str, target: str) -> Column:
    """Coordinates x, y, x, y, ... of one system in another, by way of whole pixels.

    ``size`` is a struct of height, width, and for resized pixels resized_height and
    resized_width. Whole numbers are cut off, percent are rounded to one place.
    """
    def scale(system: str, i: Column) -> Column:
        side = lambda a, b: F.when(i % 2 == 0, size[a]).otherwise(size[b]).cast("double")
        return {"abs_origin": lambda: side("width", "height"), "abs_resized": lambda: side("resized_width", "resized_height"), "qwen-vl": lambda: F.lit(999.0), "rel": lambda: F.lit(1.0), "molmo": lambda: F.lit(100.0)}[system]()

    def move(x: Column, i: Column) -> Column:
        origin = scale("abs_origin", i)
        pixel = (x.cast("double") if source == "abs_origin" else x.cast("double") / scale(source, i) * origin if source != "rel" else x.cast("double") * origin).cast("long").cast("double")
        if target == "abs_origin":
            return pixel
        if target == "rel":
            return pixel / origin
        if target == "molmo":
            return F.bround(pixel / origin * 100, 1)
        return (pixel / origin * scale(target, i)).cast("long").cast("double")

    return F.transform(box, move)


def on_screen(value: Column, side: Column, processed: Column, absolute: bool) -> Column:
    """A model's coordinate on the original screen: in pixels of the processed picture, or on a grid to 999."""
    return (value * side / (processed if absolute else F.lit(999))).cast("int")
