"""The rule language of single values, for plain values read from files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from loomtrace.functions.rules import cell_range


def _covers(outer: str, inner: str) -> bool:
    boxes = [cell_range(x) for x in outer.split()]
    return all(any(a <= r0 and b <= c0 and r1 <= c and c1 <= d for a, b, c, d in boxes) for r0, c0, r1, c1 in map(cell_range, inner.split()))


def fits_rule(value: object, method: str, ref) -> bool:
    """Whether a value satisfies a rule (``functions.rules``); what cannot be compared does not."""
    name, *rest = method.split(".")
    try:
        if name == "re":
            flags = re.RegexFlag(0)
            for f in rest:
                flags |= getattr(re, f)
            return re.search(ref, value, flags) is not None
        if method in ("eq", "ne"):
            return (value == ref) == (method == "eq")
        if method in ("le", "lt", "ge", "gt"):
            return {"le": value <= ref, "lt": value < ref, "ge": value >= ref, "gt": value > ref}[method]
        if method.startswith("approx:"):
            return abs(float(value) - ref) <= float(method.split(":", 1)[1])
        if name == "range":
            open_low, open_high = rest[0][0] == "t", rest[0][1] == "t"
            return (ref[0] < value if open_low else ref[0] <= value) and (value < ref[1] if open_high else value <= ref[1])
        if method == "spreadsheet_range":
            return _covers(str(value), ref[0]) and _covers(ref[1], str(value))
        if method in ("str_list_eq", "str_set_eq"):
            kind = list if method == "str_list_eq" else set
            return kind(value.strip("\"'").split(",")) == kind(ref)
    except (TypeError, ValueError, AttributeError):
        return False
    raise ValueError(f"no such method: {method}")


def fits_record(pattern: dict, record: dict) -> bool:
    """Whether all fields of a pattern are there and equal."""
    return all(k in record and record[k] == v for k, v in pattern.items())


def records_fit(records: Sequence[dict], rules: dict) -> bool:
    """Each expected pattern fits some record and no unexpected one fits any."""
    return all(any(fits_record(p, r) for r in records) for p in rules.get("expect", ())) and not any(fits_record(p, r) for p in rules.get("unexpect", ()) for r in records)
