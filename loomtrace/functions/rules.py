"""A rule language for single values, compiled to Columns.

A rule is (method, ref): ``re`` with flags after dots, ``eq ne le lt ge gt``,
``approx:T``, ``range.XY`` with X and Y each t (open) or e (closed),
``spreadsheet_range``, ``str_list_eq`` and ``str_set_eq``. What cannot be compared is
false, never null and never an error.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_FLAGS = {"I": "i", "IGNORECASE": "i", "S": "s", "DOTALL": "s", "M": "m", "MULTILINE": "m", "X": "x", "VERBOSE": "x"}


def java_pattern(pattern: str, flags: Sequence[str] = ()) -> str:
    """A Python pattern in the engine's syntax: flags in front, named groups and the absolute end renamed."""
    letters = "".join(sorted({_FLAGS[f.upper()] for f in flags}))
    body = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{m[1].replace('_', '')}>", pattern)
    body = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\k<{m[1].replace('_', '')}>", body).replace(r"\Z", r"\z")
    return (f"(?{letters})" if letters else "") + body


def _number(value: Column) -> Column:
    return value.cast("string").try_cast("double")


def cell_range(reference: str) -> tuple[int, int, int, int]:
    """(first row, first column, last row, last column) of a reference such as B2:D10, from 1."""
    cells = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)(?::\$?([A-Za-z]+)\$?(\d+))?", reference.strip())
    if not cells:
        raise ValueError(f"not a range: {reference}")

    def column(name: str) -> int:
        n = 0
        for c in name.upper():
            n = n * 26 + ord(c) - 64
        return n

    r0, c0 = int(cells[2]), column(cells[1])
    r1, c1 = (int(cells[4]), column(cells[3])) if cells[3] else (r0, c0)
    return min(r0, r1), min(c0, c1), max(r0, r1), max(c0, c1)


def _column(letters: Column) -> Column:
    """The number of a column by its letters, A being 1."""
    digit = lambda n: F.ascii(F.substring(letters, n, 1)) - 64
    few = F.when(F.length(letters) == 1, digit(1)).when(F.length(letters) == 2, digit(1) * 26 + digit(2)).when(F.length(letters) == 3, (digit(1) * 26 + digit(2)) * 26 + digit(3))
    return F.coalesce(few, F.aggregate(F.split(letters, ""), F.lit(0), lambda n, c: F.when(c == "", n).otherwise(n * 26 + F.ascii(c) - 64)))


_CELL = r"\$?([A-Za-z]+)\$?(\d+)"
_RANGE = rf"^\s*{_CELL}(?::{_CELL})?\s*$"


def _boxes(ranges: Column) -> Column:
    """Structs (r0, c0, r1, c1) of a text of ranges such as ``B2:D10 F1``; null for what is no range."""
    parts = F.split(F.trim(ranges), r"\s+")

    # A step's argument is evaluated once however often the step names it, so each is bound by one of its own.
    def numbers(part: Column) -> Column:
        tokens = F.when(part.rlike(_RANGE), F.regexp_extract_all(F.upper(part), F.lit("[A-Z]+|[0-9]+"), F.lit(0)))
        return F.transform(tokens, lambda t: F.when(t < "A", t.try_cast("int")).otherwise(_column(t)))

    def box(n: Column) -> Column:
        last = F.size(n)
        column, row = F.get(n, last - 2), F.get(n, last - 1)
        return F.struct(F.least(n[1], row).alias("r0"), F.least(n[0], column).alias("c0"), F.greatest(n[1], row).alias("r1"), F.greatest(n[0], column).alias("c1"))

    return F.transform(F.transform(parts, numbers), lambda n: F.when(n.isNotNull(), box(n)))


def _listed(ranges) -> list[tuple[int, int, int, int]]:
    return [cell_range(x) for x in (ranges.split() if isinstance(ranges, str) else ranges)]


def _covers(boxes: Column, inner) -> Column:
    """Each of the fixed ranges lies in one of the boxes."""
    test = F.lit(True)
    for r0, c0, r1, c1 in _listed(inner):
        test = test & F.exists(boxes, lambda b: (b["r0"] <= r0) & (b["c0"] <= c0) & (b["r1"] >= r1) & (b["c1"] >= c1))  # noqa: B023
    return test


def _covered(boxes: Column, outer) -> Column:
    """Each box lies in one of the fixed ranges."""
    def inside(b: Column) -> Column:
        test = F.lit(False)
        for r0, c0, r1, c1 in _listed(outer):
            test = test | ((b["r0"] >= r0) & (b["c0"] >= c0) & (b["r1"] <= r1) & (b["c1"] <= c1))
        return test

    return F.forall(boxes, inside)


def rule(value: Column, method: str, ref) -> Column:
    """Whether ``value`` satisfies the rule."""
    name, *rest = method.split(".")
    if name == "re":
        found = value.cast("string").rlike(java_pattern(ref, rest))
    elif method in ("eq", "ne", "le", "lt", "ge", "gt"):
        if isinstance(ref, bool) or ref is None:
            left, right = value, F.lit(ref)
        elif isinstance(ref, int | float):
            left, right = _number(value), F.lit(float(ref))
        else:
            left, right = value.cast("string"), F.lit(ref)
        if method in ("eq", "ne"):
            same = left.eqNullSafe(right)
            return same if method == "eq" else ~same
        found = {"le": left <= right, "lt": left < right, "ge": left >= right, "gt": left > right}[method]
    elif method.startswith("approx:"):
        found = F.abs(_number(value) - float(ref)) <= float(method.split(":", 1)[1])
    elif name == "range" and rest and re.fullmatch("[te]{2}", rest[0]):
        low, high = (float(x) for x in ref)
        x = _number(value)
        found = (x > low if rest[0][0] == "t" else x >= low) & (x < high if rest[0][1] == "t" else x <= high)
    elif method == "spreadsheet_range":
        # As the element of an array the boxes are read once for all tests.
        found = F.transform(F.array(_boxes(value)), lambda boxes: _covers(boxes, ref[0]) & _covered(boxes, ref[1]))[0]
    elif method in ("str_list_eq", "str_set_eq"):
        parts = F.transform(F.split(F.regexp_replace(value.cast("string"), r"^[\"']+|[\"']+$", ""), ","), lambda x: F.trim(x))
        wanted = F.array(*map(F.lit, ref))
        if method == "str_set_eq":
            parts, wanted = F.array_sort(F.array_distinct(parts)), F.array_sort(F.array_distinct(wanted))
        found = parts == wanted
    else:
        raise ValueError(f"no such method: {method}")
    return F.coalesce(found, F.lit(False))


def includes(text: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """1.0 if every string of ``include`` occurs in the text and none of ``exclude``; 0.0 otherwise and for null."""
    test = F.lit(True)
    for s in include:
        test = test & text.contains(s)
    for s in exclude:
        test = test & ~text.contains(s)
    return F.when(text.isNotNull() & test, 1.0).otherwise(0.0)


def matches_record(row: Mapping[str, Column], pattern: Mapping[str, object]) -> Column:
    """Whether all fields of a pattern are there and equal."""
    if any(k not in row for k in pattern):
        return F.lit(False)
    test = F.lit(True)
    for k, v in pattern.items():
        test = test & row[k].cast("string").eqNullSafe(F.lit(v).cast("string"))
    return test


def expected_records(test_of, expect: Sequence, unexpect: Sequence = ()) -> Column:
    """An aggregate over rows: 1.0 if each expected pattern fits some row and no unexpected one fits any.

    ``test_of`` gives the Column that tests a row for a pattern.
    """
    verdict = F.lit(True)
    for p in expect:
        verdict = verdict & F.coalesce(F.bool_or(test_of(p)), F.lit(False))
    for p in unexpect:
        verdict = verdict & ~F.coalesce(F.bool_or(test_of(p)), F.lit(False))
    return F.when(verdict, 1.0).otherwise(0.0)


def json_at(text: Column, path: Sequence[str | int]) -> Column:
    """The value at a path of keys and positions in JSON text, as text; null where there is none."""
    steps = "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in path)
    return F.get_json_object(text, "$" + steps)


def subset(inner: Column, outer: Column) -> Column:
    """Whether every entry of map ``inner`` is in map ``outer``."""
    return F.forall(F.map_entries(inner), lambda e: F.map_contains_key(outer, e["key"]) & F.try_element_at(outer, e["key"]).eqNullSafe(e["value"]))


def truthy_and(a: Column, b: Column) -> Column:
    """``a and b`` of numbers as Python has it: b unless a is zero."""
    return F.when(a != 0, b).otherwise(a)


def truthy_or(a: Column, b: Column) -> Column:
    """``a or b`` of numbers: a unless it is zero."""
    return F.when(a != 0, a).otherwise(b)


def rescaled(score: Column, base: float, margin: float = 0.01) -> Column:
    """A score above what an untouched file would get, on a scale from that to 1."""
    return F.when(score >= base + margin, (score - base) / (1 - base)).otherwise(0.0)
