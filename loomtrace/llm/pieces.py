"""An order cut into pieces of bounded size at quantiles of a whole number, in two levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Coarse pieces, and fine ones within each: what is known of them has a proven size.
COARSE, FINE = 1_024, 256
_STEP = 32


def _below(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda c: c < value))


def with_pieces(frame: DataFrame, column: str, rows: int, into: str = "piece") -> DataFrame:
    """``frame`` with the number of the piece that its ``column`` (a long) falls into, about ``rows`` rows each.

    Greater values never lie in lesser pieces, and equal ones share one. Coarse cuts are
    quantiles of all values; each coarse piece is cut by quantiles of its own, found
    with one aggregate over all of them and broadcast (COARSE arrays of FINE longs at
    most, 2 MB). A null has a null piece.
    """
    own = frame.select(F.col(column).alias("v")).filter("v is not null")
    n = max(1, own.count() // rows)
    if n == 1:
        return frame.withColumn(into, F.when(F.col(column).isNotNull(), F.lit(0).cast("long")))
    coarse = min(COARSE, n)
    cuts = sorted(set(own.agg(F.percentile_approx("v", [i / coarse for i in range(1, coarse)], 10 * coarse)).first()[0]))
    literal = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    value = F.col(column)

    def place(v: Column) -> Column:
        """The coarse piece: a step over every _STEP-th cut, then over the ones between."""
        block = _below(literal(cuts[_STEP - 1 :: _STEP]), v) * _STEP if len(cuts) >= _STEP else F.lit(0)
        return (block + _below(F.slice(literal(cuts), block + 1, F.lit(_STEP)), v)).cast("long")

    if n <= COARSE:
        return frame.withColumn(into, F.when(value.isNotNull(), place(value)))
    fine = min(FINE, -(-n // coarse))
    bounds = own.groupBy(place(F.col("v")).alias("__coarse")).agg(F.percentile_approx("v", [i / fine for i in range(1, fine)], 10 * fine).alias("__cuts"))
    found = frame.withColumn("__coarse", place(value)).join(F.broadcast(bounds), "__coarse", "left")
    number = F.col("__coarse") * FINE + _below(F.array_distinct("__cuts"), value)
    return found.withColumn(into, F.when(value.isNotNull(), number)).drop("__coarse", "__cuts")
