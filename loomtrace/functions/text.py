"""Text functions: normal forms, structured parts of answers, and likeness ratios."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def stripped(text: Column) -> Column:
    """The text without white space at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def squeezed(text: Column) -> Column:
    """The text with one blank for each run of white space, trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normal_text(text: Column, ignore_blanks: bool = False, ignore_case: bool = False) -> Column:
    for wanted, form in ((ignore_blanks, squeezed), (ignore_case, F.lower)):
        text = form(text) if wanted else text
    return text


def same_text(a: Column, b: Column, ignore_blanks: bool = False, ignore_case: bool = False) -> Column:
    """1.0 if two texts are the same, after the chosen normal forms."""
    return normal_text(a, ignore_blanks, ignore_case).eqNullSafe(normal_text(b, ignore_blanks, ignore_case)).cast("double")


def indel(a: str, b: str) -> float:
    """2 * longest common subsequence / (len(a) + len(b)), with a bit for each character of ``a``; 1 for two empty texts."""
    if not a and not b:
        return 1.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """``indel`` of two columns; null counts as empty."""
    return pd.Series([indel(x or "", y or "") for x, y in zip(a, b, strict=True)])


@F.pandas_udf(ArrayType(DoubleType()))
def indel_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """``indel`` of the items of two arrays in turn, as far as both go."""
    return pd.Series([None if x is None or y is None else [indel(p or "", q or "") for p, q in zip(x, y)] for x, y in zip(a, b, strict=True)])


@F.pandas_udf(DoubleType())
def line_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The matching-blocks ratio of two texts over their lines."""
    return pd.Series([SequenceMatcher(None, (x or "").splitlines(), (y or "").splitlines()).ratio() for x, y in zip(a, b, strict=True)])


def vision_tags(text: Column) -> tuple[Column, Column]:
    """(the text with ``<image>`` for each marked picture, the pictures)."""
    pattern = r"(?s)<\|vision_start\|>(.*?)<\|vision_end\|>"
    return F.regexp_replace(text, pattern, "<image>"), F.regexp_extract_all(text, F.lit(pattern), 1)


def fenced_code(answer: Column) -> Column:
    """The first python fence of an answer, else its first fence, else all of it, trimmed."""
    first = lambda p: F.nullif(stripped(F.regexp_extract(answer, p, 1)), F.lit(""))
    return F.coalesce(first(r"(?s)```python\s*\n(.*?)```"), first(r"(?s)```\w*\s*\n(.*?)```"), stripped(answer))


def json_of_answer(answer: Column) -> Column:
    """The first JSON value of an answer, as text: the whole of it, else the first object that reads in a fence or in backticks, else in the text with one level of nesting; else null."""
    whole = stripped(answer)
    reads = lambda x: F.try_parse_json(x).isNotNull()
    first = lambda p: F.get(F.filter(F.transform(F.regexp_extract_all(answer, F.lit(p), F.lit(1)), stripped), reads), F.lit(0))
    places = (r"(?is)```json\s*(\{.*?\})\s*```", r"(?s)```\s*(\{.*?\})\s*```", r"(?s)`(\{.*?\})`", r"(\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\})")
    return F.coalesce(F.when(reads(whole), whole), *map(first, places))


def sections(answer: Column) -> tuple[Column, Column]:
    """(observation, steps): the first observation, and structs (thought, action) paired as far as both go."""
    part = lambda name: F.regexp_extract_all(answer, F.lit(rf"(?is)<{name}>(.*?)</{name}>"), 1)
    thoughts, actions = part("thought"), part("action")
    n = F.least(F.size(thoughts), F.size(actions))
    steps = F.zip_with(F.slice(thoughts, F.lit(1), n), F.slice(actions, F.lit(1), n), lambda t, a: F.struct(stripped(t).alias("thought"), stripped(a).alias("action")))
    return stripped(F.try_element_at(part("observation"), F.lit(1))), steps


def parse_action(text: Column) -> tuple[Column, Column]:
    """(name, args) of ``name(a, b)`` at the beginning of a text; null where it does not fit."""
    pattern = r"^(\w+)\((.*?)\)"
    fits = text.rlike(pattern)
    args = F.regexp_extract(text, pattern, 2)
    parts = F.transform(F.split(args, ","), lambda x: F.trim(x))
    return F.when(fits, F.regexp_extract(text, pattern, 1)), F.when(fits, F.when(args == "", F.slice(parts, 1, 0)).otherwise(parts))


def denormalised(value: Column, size: int, grid: int = 1000) -> Column:
    """A coordinate of a grid in pixels, cut off to a whole number."""
    return (value.cast("double") / grid * size).cast("int")


#: Arity of each verb of the action language.
VERBS = {"click": 2, "left_double": 2, "right_single": 2, "drag": 4, "hotkey": 1, "type": 1, "scroll": 3, "wait": 0, "finish": 0, "call_user": 0}


def valid_action(text: Column, width: int, height: int) -> Column:
    """The action with pixels for grid coordinates; ``wait()`` for an unknown verb or wrong arguments."""
    name, args = parse_action(text)
    number = lambda i: F.get(args, i).try_cast("int")
    whole = lambda *at: F.forall(F.slice(args, at[0] + 1, at[1]), lambda x: x.try_cast("int").isNotNull())
    at = lambda i, size: denormalised(number(i), size).cast("string")
    point = F.concat(name, F.lit("("), at(0, width), F.lit(","), at(1, height), F.lit(")"))
    drag = F.concat(F.lit("drag("), at(0, width), F.lit(","), at(1, height), F.lit(","), at(2, width), F.lit(","), at(3, height), F.lit(")"))
    way = F.get(args, 2)
    scroll = F.concat(F.lit("scroll("), at(0, width), F.lit(","), at(1, height), F.lit(","), F.when(way == "up", "50").otherwise("-50"), F.lit(")"))
    made = (
        F.when(name.isin("click", "left_double", "right_single") & (F.size(args) == 2) & whole(0, 2), point)
        .when((name == "drag") & (F.size(args) == 4) & whole(0, 4), drag)
        .when((name == "scroll") & (F.size(args) == 3) & whole(0, 2) & way.isin("up", "down"), scroll)
        .when(name.isin("hotkey", "type") & (F.size(args) == 1), F.concat(name, F.lit("("), F.get(args, 0), F.lit(")")))
        .when(name.isin("wait", "finish", "call_user") & (F.size(args) == 0), F.concat(name, F.lit("()")))
    )
    return F.coalesce(made, F.lit("wait()"))


def pad_left(ids: Column, n: int, pad: int = 0) -> Column:
    """The last n ids, padded in front."""
    return F.concat(F.array_repeat(F.lit(pad).cast("long"), F.greatest(F.lit(0), F.lit(n) - F.size(ids))), F.when(F.size(ids) > n, F.slice(ids, -n, n)).otherwise(ids))


def pad_right(ids: Column, n: int, pad: int = 0) -> Column:
    """The first n ids, padded behind."""
    return F.concat(F.slice(ids, 1, n), F.array_repeat(F.lit(pad).cast("long"), F.greatest(F.lit(0), F.lit(n) - F.size(ids))))


def last_setting(text: Column, key: str, default: str | None) -> Column:
    """The value of the last ``key=value`` line of a configuration text, or the default."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.startswith(f"{key}="))
    return F.coalesce(F.substring(F.try_element_at(lines, F.lit(-1)), len(key) + 2, 1 << 30), F.lit(default))
