"""The name join against the plain distance of all pairs, over alphabets in which many names are near, and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from loomtrace.llm.names import name_distance, name_join, near_names


def distance(a, b):
    """Optimal string alignment, cell by cell."""
    rows = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


def edited(rng, name, letters):
    for _ in range(rng.integers(0, 4)):
        at = int(rng.integers(0, len(name) + 1))
        kind = rng.integers(0, 4)
        new = str(rng.choice(letters))
        if kind == 0:
            name = name[:at] + new + name[at:]
        elif kind == 1:
            name = name[:at] + name[at + 1 :]
        elif kind == 2:
            name = name[:at] + new + name[at + 1 :]
        else:
            name = name[:at] + name[at : at + 2][::-1] + name[at + 2 :]
    return name


def names(rng, count, letters, longest):
    base = ["".join(rng.choice(letters, rng.integers(1, longest + 1))) for _ in range(count)]
    return sorted({n for b in base for n in (b, *(edited(rng, b, letters) for _ in range(4))) if n})


def test_all_near_pairs(spark):
    rng = np.random.default_rng(11)
    short, long = names(rng, 45, list("abé"), 7), names(rng, 45, list("abcdeföあ "), 20)
    left, right = short[::2] + long[::2], short[1::2] + long[1::2] + short[:20:2]
    wanted = {(a, b, distance(a, b)) for a in left for b in right if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2}
    found = near_names(*(spark.createDataFrame([(x,) for x in side], "name string") for side in (left, right))).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == wanted
    assert {d for _, _, d in wanted} == {0, 1, 2} and len(wanted) > 300


def test_distances(spark):
    rng = np.random.default_rng(12)
    letters = list("abc")
    pairs = [("ca", "abc"), ("ca", "ca"), ("abcd", "badc"), ("", ""), ("a", ""), ("ab", ""), ("abc", "")]
    pairs += [(a, edited(rng, a, letters)) for a in ("".join(rng.choice(letters, rng.integers(1, 10))) for _ in range(600))]
    frame = spark.createDataFrame(pairs, "a string, b string").withColumn("d", name_distance(F.col("a"), F.col("b")))
    assert all(r.d == (d if (d := distance(r.a, r.b)) <= 2 else None) for r in frame.collect())


def plain_join(vendors, clients):
    out = {}
    for v, name in {(v, n) for v, n in vendors if n}:
        h, size = zlib.crc32(str(v).encode()) if v is not None else 1, len(name)
        if h % 2 == 0 and size >= 2:
            at = h % (size - 1)
            name = name[:at] + name[at + 1] + name[at] + name[at + 2 :]
        out.setdefault((v, name), None)
    sums = {}
    for v, name in out:
        for c, other in clients:
            if other and abs(len(name) - len(other)) <= 2 and (d := distance(name, other)) <= 2:
                n, ids = sums.setdefault((v, d), (0, []))
                sums[v, d] = n + 1, ids + ([c] if c is not None else [])
    return {(v, d, n, min(ids, default=None), sum(zlib.crc32(str(c).encode()) for c in ids) if ids else None) for (v, d), (n, ids) in sums.items()}


def test_the_join_and_odd_rows(spark):
    rng = np.random.default_rng(13)
    pool = names(rng, 30, list("abcdé "), 12)
    vendors = [(int(i), str(rng.choice(pool))) for i in range(60)] + [(3, "again"), (3, "again"), (None, "nobody"), (70, None), (71, ""), (72, "x"), (73, "xy"), (74, "q" * 3000)]
    clients = [(int(i), str(rng.choice(pool))) for i in range(150)]
    clients += [(5, "again"), (5, "again"), (None, "nobody"), (900, "nobodi"), (901, None), (902, ""), (903, "y"), (904, "yx"), (905, "xyzz"), (906, "q" * 2999), (907, "agian")]
    left = spark.createDataFrame([(v, n, 1) for v, n in vendors], "vendor_id long, name string, distance int")
    right = spark.createDataFrame([(c, n, "x") for c, n in clients], "client_id long, name string, key string")
    rows = name_join(left, right).collect()
    assert len(rows) == len({tuple(r) for r in rows}) and {tuple(r) for r in rows} == plain_join(vendors, clients)
    assert name_join(left.limit(0), right).collect() == [] and name_join(left, right.limit(0)).collect() == []


def test_a_hot_name_is_one_row(spark):
    clients = spark.range(20_000).select(F.col("id").alias("client_id"), F.when(F.col("id") % 3 > 0, F.lit("Hot Name")).otherwise(F.concat(F.lit("n"), F.col("id"))).alias("name"))
    vendors = spark.createDataFrame([(1, "Hot Name")], "vendor_id long, name string")
    rows = name_join(vendors, clients).collect()
    assert [(r.vendor_id, r.n_clients, r.first_client_id) for r in rows] == [(1, 13_333, 1)]
