"""JSON values by their hash: types, numbers, orders, escapes, and texts that are none."""

import itertools
import json

from pyspark.sql import functions as F

from loomtrace.functions.json_hash import json_hash


def canonical(value, ignore_order):
    if isinstance(value, dict):
        return ("object", tuple(sorted((k, canonical(v, ignore_order)) for k, v in value.items())))
    if isinstance(value, list):
        items = [canonical(v, ignore_order) for v in value]
        return ("list", tuple(sorted(items, key=repr) if ignore_order else items))
    if isinstance(value, bool) or value is None:
        return ("word", repr(value))
    return ("number", float(value)) if isinstance(value, int | float) else ("text", value)


TEXTS = [
    "1", "1.0", "1e0", "10E-1", "-0", "0", "0.0", '"1"', "true", '"true"', "null", '"null"', "[]", "{}", "[[]]", "[{}]", "[1,2]", "[2,1]", " [ 1.0 , 2 ] ", "[1,[2,3]]", "[[3,2],1]", "[1,2,2]", "[1,1,2]",
    '{"a":1,"b":[1,2]}', '{"b":[1,2],"a":1.0}', '{"b":[2,1],"a":1}', '{"a":"1","b":[1,2]}', '{"a":{"b":1}}', '{"b":{"a":1}}', '{"a":null}', '["a",null]', '{"a":"x"}', '["a","x"]', '["x","a"]',
    '"A"', '"\\u0041"', '"a\\"b"', '"a\\\\"', '"[1]"', '"{"', '"é"', '"\\u00e9"', '""', '{"":""}', '{"\\u0061":null}', '[true,false]', '[false,true]',
]


def test_equal_values_share_a_hash_and_others_do_not(spark):
    for ignore_order in (False, True):
        rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", json_hash(F.col("t"), ignore_order).alias("h")).collect()
        found = {r.t: r.h for r in rows}
        assert None not in found.values()
        for a, b in itertools.combinations(TEXTS, 2):
            assert (found[a] == found[b]) == (canonical(json.loads(a), ignore_order) == canonical(json.loads(b), ignore_order)), (a, b, ignore_order)


def test_what_is_none_and_what_is_large(spark):
    deep = "[" * 60 + "]" * 60
    long = json.dumps(list(range(20_000)))
    texts = [None, "", "{", '{"a":1', "[1,]", '{"a":1,"a":2}', "nope", deep, long, "9007199254740993", "9007199254740992"]
    found = [r.h for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", json_hash(F.col("t")).alias("h")).orderBy("i").collect()]
    assert found[:7] == [None] * 7 and None not in found[7:] and len(set(found[7:])) == 4


def test_many_texts_in_little_time(spark):
    """Sixty thousand texts of thirty tokens, which a fold over tokens in built-in functions takes a minute and more for."""
    import time

    json_hash_of = lambda rows: rows.select(json_hash(F.col("t"), ignore_order=True).alias("h")).agg(F.countDistinct("h").alias("n")).first().n
    texts = lambda n: spark.range(0, n, 1, 4).select(F.format_string('{"k": %d, "items": [{"sku": 1, "qty": 2.0}, {"qty": %d, "sku": 1}], "tags": ["a", "b", %d]}', F.col("id") % 1000, F.col("id") % 2, F.col("id")).alias("t"))
    assert json_hash_of(texts(10)) == 10
    began = time.perf_counter()
    assert json_hash_of(texts(60_000)) == 60_000
    assert time.perf_counter() - began < 30
    # A list within lists as deep as JSON is read.
    assert spark.createDataFrame([("[" * 900 + "]" * 900,)], "t string").filter(json_hash(F.col("t")).isNotNull()).count() == 1
