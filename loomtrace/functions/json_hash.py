"""A hash of JSON texts by value, so that texts of one value are found by an equality join.

Types are told apart ('1' is not 1), numbers count by value (1 is 1.0), objects by their
entries in any order, and lists by their elements in order, or in any with
``ignore_order``. Built-in functions say what is JSON and hash; between them Arrow batches
of texts are read and written again in one form for each value, as a fold over tokens in
built-in functions takes about a hundred times as long.
"""

from __future__ import annotations

import json
import sys
from json.encoder import encode_basestring_ascii as quoted

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on doubles do not tell whole numbers apart.
_EXACT = float(1 << 53)
#: Calls within calls that a deep text needs; what is JSON is some hundred levels deep at most.
_DEEP = 20_000


class _Whole(str):
    """The digits of a whole number that counts by them."""

    __slots__ = ()


def _whole(digits: str) -> float | _Whole:
    number = float(digits)
    return number if abs(number) < _EXACT else _Whole(digits)


def _form(value: object, ignore_order: bool) -> str:
    kind = type(value)
    if kind is str:
        return quoted(value)
    if kind is float:
        return repr(value + 0.0)  # -0 is 0
    if kind is dict:
        return "{" + ",".join(sorted([quoted(k) + ":" + _form(v, ignore_order) for k, v in value.items()])) + "}"
    if kind is list:
        items = [_form(v, ignore_order) for v in value]
        return "[" + ",".join(sorted(items) if ignore_order else items) + "]"
    return "w" + value if kind is _Whole else str(value)


def canonical(text: str | None, ignore_order: bool = False) -> str | None:
    """A text that equal JSON values share and no others do; null for null and for what cannot be read."""
    if text is None:
        return None
    try:
        return _form(json.loads(text, parse_int=_whole), ignore_order)
    except ValueError:
        return None


def json_hash(text: Column, ignore_order: bool = False) -> Column:
    """64 bits that equal JSON values share, whatever text they stand in; null for null and for what is no JSON.

    An object that names a key twice is no JSON. Whole numbers beyond 2 ** 53 count by
    their digits.
    """

    @F.pandas_udf("string")
    def forms(texts: pd.Series) -> pd.Series:
        before = sys.getrecursionlimit()
        sys.setrecursionlimit(max(before, _DEEP))
        try:
            return pd.Series([canonical(t, ignore_order) for t in texts], index=texts.index, dtype=object)
        finally:
            sys.setrecursionlimit(before)

    # The texts that are no JSON are left out before they are read.
    form = forms(F.when(F.try_parse_json(text).isNotNull(), text))
    return F.when(form.isNotNull(), F.xxhash64(form))
