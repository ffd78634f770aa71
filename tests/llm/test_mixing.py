"""Mixing against a direct evaluation in Python: budgets, shortages, epochs and prefixes."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from loomtrace.llm.mixing import NAMELESS, mix, mixed_documents
from loomtrace.llm.queries import MIX_WEIGHTS, WEIGHTS_SCHEMA, domain_of
from loomtrace.sources.tables import table


def share_out(budget, children):
    """children: name -> (cap, weight). Fill level by level, then whole tokens in the order of cap / weight."""
    got, open_, left = {}, {n: c for n, c in children.items()}, budget
    while open_:
        total = sum(w for _, w in open_.values())
        full = [n for n, (cap, w) in open_.items() if Fraction(cap) * total <= Fraction(left) * w or w == 0]
        if not full:
            break
        n = min(full, key=lambda x: (children[x][0] / children[x][1] if children[x][1] else 0.0, x))
        got[n] = children[n][0]
        left -= got[n]
        del open_[n]
    total = sum(w for _, w in open_.values())
    for n, (_, w) in open_.items():
        got[n] = w * left // total
    for n in sorted(open_, key=lambda x: (children[x][0] / children[x][1], x))[: budget - sum(got.values())]:
        got[n] += 1
    return got


def brute(rows, weights, tokens, seed, epochs):
    """rows: (doc_id, domain, lang, source, tokens, text)."""
    weight = {tuple(x for x in w[:3] if x is not None): w[3] for w in weights}
    supply = Counter()
    for _, d, l, s, n, _ in rows:
        supply[d, l, s] += n
    w = lambda path: weight.get(path, 1)
    caps = {p: n * epochs if all(w(p[:i]) for i in (1, 2, 3)) else 0 for p, n in supply.items()}
    level = {(): min(tokens, sum(caps.values()))}
    for depth in (1, 2, 3):
        below = {}
        for parent, budget in level.items():
            children = defaultdict(int)
            for p, cap in caps.items():
                if p[: depth - 1] == parent:
                    children[p[:depth]] += cap
            below.update(share_out(budget, {c: (cap, w(c)) for c, cap in children.items()}))
        level = below
    out = []
    for leaf, budget in level.items():
        own = [r for r in rows if r[1:4] == leaf and r[4]]
        if not supply[leaf]:
            continue
        whole, rest = divmod(budget, supply[leaf])
        out += [(r[0], *leaf, e, r[4], r[4]) for r in own for e in range(whole)]
        key = lambda r: (hashlib.md5(f"{seed}:{whole}:{'null' if r[0] is None else r[0]}:{hashlib.md5((r[5] or '').encode()).hexdigest()}".encode()).hexdigest(), r[0] or 0, r[4])  # noqa: E731, B023
        for r in sorted(own, key=key):
            if rest > 0:
                out.append((r[0], *leaf, whole, r[4], min(rest, r[4])))
                rest -= out[-1][-1]
    return sorted(out, key=str), level


def tokens_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_documents_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    weights = spark.createDataFrame(MIX_WEIGHTS, WEIGHTS_SCHEMA)
    rows = [(r.doc_id, r.domain, r.lang, r.source, tokens_of(r.text), r.text) for r in docs.withColumn("domain", domain_of(F.col("source"))).collect()]
    total = sum(r[4] for r in rows)
    for share, epochs in ((0.5, 4), (0.9, 1), (9.0, 3)):
        got = sorted((tuple(r) for r in mix(docs, domain_of(docs["source"]), weights, share=share, seed=17, epochs=epochs).collect()), key=str)
        wanted, level = brute(rows, MIX_WEIGHTS, int(total * share), 17, epochs)
        assert got == wanted
        assert sum(r[-1] for r in got) == min(int(total * share), total * epochs) == sum(level.values())


def test_shortages_nulls_ties_and_clashing_names(spark):
    rnd = random.Random(6)
    rows = [(i % 90 if i % 11 else None, rnd.choice("ab"), rnd.choice(["en", None]), rnd.choice(["x", "y", "z", None]), rnd.choice([0, 1, 5, 40])) for i in range(200)]
    rows += [(1000 + i, "c", "en", "hot", 7) for i in range(300)] + [(5000, "d", "en", "never", 10), (5001, "c", "de", "long", 9000)]
    rows = [r for n, r in enumerate(rows) if r not in rows[:n]]
    data = [(i, " ".join(["w"] * n) if n else rnd.choice([None, "", " "]), l, s, d, "t") for i, d, l, s, n in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, d string, tokens string")
    weights = [("a", None, None, 3), ("c", None, None, 1), ("c", "en", None, 2), ("c", "de", None, 1), ("d", None, None, 0), ("a", "en", "x", 5), ("a", "en", "y", 0)]
    frame = spark.createDataFrame(weights, WEIGHTS_SCHEMA)
    plain = [(i, d, l or NAMELESS, s or NAMELESS, n, t[1]) for (i, d, l, s, n), t in zip(rows, data, strict=True)]
    for tokens, epochs in ((1, 1), (3001, 1), (9000, 2), (10**7, 3), (0, 1)):
        got = sorted((tuple(r) for r in mix(docs, docs["d"], frame, tokens=tokens, seed=3, epochs=epochs).collect()), key=str)
        assert got == brute(plain, weights, tokens, 3, epochs)[0], (tokens, epochs)
    kept = mixed_documents(docs, docs["d"], frame, tokens=3001, seed=3)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in brute(plain, weights, 3001, 3, 1)[0])
    assert mix(docs.limit(0), F.col("d"), frame).collect() == [] and mixed_documents(docs.limit(0), F.col("d"), frame).collect() == []
    assert mix(docs, docs["d"], frame.limit(0), tokens=100, epochs=1).agg(F.sum("taken")).first()[0] == 100


def test_rows_without_an_id_are_not_in_one_bucket(spark):
    """Of many rows without an id, or of one, few meet where a leaf's prefix ends."""
    from loomtrace.llm import mixing

    rows = [(None if i % 2 else 7, f"text {i}", "en", "s") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("tokens", F.lit(2)).withColumn("domain", F.lit("d"))
    keyed = docs.select("doc_id", mixing._digest(F.col("text"))).select(F.substring(mixing._order_key(3, F.lit(0)), 1, mixing.BUCKET_DIGITS).alias("bucket"))
    assert keyed.groupBy("bucket").count().agg(F.max("count")).first()[0] < 30
    got = mix(docs.drop("tokens"), F.lit("d"), spark.createDataFrame([], WEIGHTS_SCHEMA), tokens=3001, seed=3, epochs=1)
    assert got.agg(F.sum("taken")).first()[0] == 3001 and got.count() == 1501
