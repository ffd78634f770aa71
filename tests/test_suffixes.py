"""Public suffixes: cases that the public list's own tests name, in the expression and by the join."""

from pyspark.sql import functions as F

from loomtrace.functions.suffixes import SUFFIX_RULES, registrable_domain, with_suffix

# Hosts and their registrable domains, as published with the list.
CASES = {
    None: None, "": None, "COM": None, "example.COM": "example.com", "WwW.example.COM": "example.com", ".com": None, ".example": None, "example": None, "example.example": "example.example", "b.example.example": "example.example",
    "biz": None, "domain.biz": "domain.biz", "a.b.domain.biz": "domain.biz", "com": None, "b.example.com": "example.com", "mm": None, "c.mm": None, "b.c.mm": "b.c.mm", "a.b.c.mm": "b.c.mm",
    "jp": None, "test.jp": "test.jp", "www.test.jp": "test.jp", "ac.jp": None, "test.ac.jp": "test.ac.jp", "kyoto.jp": None, "test.kyoto.jp": "test.kyoto.jp", "ide.kyoto.jp": None, "b.ide.kyoto.jp": "b.ide.kyoto.jp", "a.b.ide.kyoto.jp": "b.ide.kyoto.jp",
    "c.kobe.jp": None, "b.c.kobe.jp": "b.c.kobe.jp", "a.b.c.kobe.jp": "b.c.kobe.jp", "city.kobe.jp": "city.kobe.jp", "www.city.kobe.jp": "city.kobe.jp",
    "ck": None, "test.ck": None, "b.test.ck": "b.test.ck", "a.b.test.ck": "b.test.ck", "www.ck": "www.ck", "www.www.ck": "www.ck",
    "us": None, "test.us": "test.us", "ak.us": None, "test.ak.us": "test.ak.us", "k12.ak.us": None, "test.k12.ak.us": "test.k12.ak.us", "www.test.k12.ak.us": "test.k12.ak.us",
}


def test_published_cases(spark):
    frame = spark.createDataFrame([(h,) for h in CASES], "host string")
    found = {r.host: r.d for r in frame.select("host", registrable_domain(F.col("host")).alias("d")).collect()}
    assert found == CASES


def test_the_join_gives_the_same(spark):
    frame = spark.createDataFrame([(h, 1) for h in CASES] * 2, "host string, n int")
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    rows = with_suffix(frame, rules).collect()
    assert len(rows) == 2 * len(CASES)
    for r in rows:
        if r.host in (None, ""):
            assert r.suffix is None
        elif not r.host.startswith("."):
            wanted = CASES[r.host]
            assert r.suffix == (wanted.split(".", 1)[1] if wanted else r.host.lower()), r.host
