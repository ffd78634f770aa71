"""Edit-distance join of names by partitioned neighbourhoods.

A name is cut into three pieces. Two edits of a name leave one piece within one plain
edit of what stands in its place in the other name, and more can be said: an edit
touches one piece, but for an exchange of the two characters at a border, which touches
two. So either a piece is left alone, or all three are touched and an exchange across a
border is all that touches the first or the last piece. Of the one-deletion variants of
pieces only two are needed for that: the first piece without its last character and the
last one without its first, each with the exchanged pair beside it. Whole pieces and
variants meet, as equal keys, the other side's substrings: those at the start, at the
end, and in the middle shifted by as many places as two edits allow. The names that
meet are then compared whole, within the join.

Equal names are joined once, so a hot name is one row, and no key holds more than names
that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.scratch import Scratch

#: Greatest distance of a pair; the pieces and their shifts are those of two edits.
MOST = 2

_START, _MIDDLE, _END, _START_PAIR, _END_PAIR = range(5)


def _key(kind: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def _cut(name: Column, start: Column | int, length: Column | int) -> Column:
    """``length`` characters from ``start``, counted from 0."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.substr(name, as_column(start) + 1, F.greatest(F.lit(0), as_column(length)))


def piece_keys(name: Column) -> Column:
    """Keys of a name's pieces: the first, the last, the middle one with its name's length, and the two variants at borders."""
    n = F.length(name)
    third = F.floor(n / 3).cast("int")
    last = n - third
    swapped = F.concat(_cut(name, 0, third - 1), _cut(name, third, 1), _cut(name, third - 1, 1))
    swapped_end = F.concat(_cut(name, last, 1), _cut(name, last - 1, 1), _cut(name, last + 1, third - 1))
    longer = F.array(
        _key(_START, third, _cut(name, 0, third)), _key(_END, third, _cut(name, last, third)), _key(_MIDDLE, n, _cut(name, third, n - 2 * third)),
        _key(_START_PAIR, third, swapped), _key(_END_PAIR, third, swapped_end),
    )
    # Names of one or two characters have empty pieces, which meet all names of up to four.
    return F.when(third == 0, F.array(_key(_START, third, F.lit("")))).otherwise(longer)


def substring_keys(name: Column) -> Column:
    """Keys of a name's substrings that the pieces of a name within two edits can meet."""
    n = F.length(name)
    lengths = F.filter(F.transform(F.sequence(F.lit(-MOST), F.lit(MOST)), lambda d: n + d), lambda m: m > 0)
    thirds = F.array_distinct(F.transform(lengths, lambda m: F.floor(m / 3).cast("int")))

    def ends(third: Column) -> Column:
        start, end = _cut(name, 0, third), _cut(name, F.greatest(n - third, F.lit(0)), third)
        pair, end_pair = _cut(name, 0, third + 1), _cut(name, F.greatest(n - third - 1, F.lit(0)), third + 1)
        outer = F.array(_key(_START, third, start), _key(_END, third, end), _key(_START_PAIR, third, pair), _key(_END_PAIR, third, end_pair))
        return F.when(third == 0, F.array(_key(_START, third, F.lit("")))).otherwise(outer)

    def middles(m: Column) -> Column:
        third = F.floor(m / 3).cast("int")
        # A shift of s before the piece and the rest behind it take |s| + |n - m - s| edits at least.
        shifts = F.filter(F.sequence(F.lit(-MOST), F.lit(MOST)), lambda s: (F.abs(s) + F.abs(n - m - s) <= MOST) & (third + s >= 0) & (third > 0))
        return F.transform(shifts, lambda s: _key(_MIDDLE, m, _cut(name, third + s, m - 2 * third)))

    return F.array_distinct(F.concat(F.flatten(F.transform(thirds, ends)), F.flatten(F.transform(lengths, middles))))


def _mask(name: Column) -> Column:
    """A bit for each character that a name has."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c), F.lit(64)))
    return F.aggregate(F.split(name, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseOR(bit(c)))


def _exchanged(a: Column, b: Column) -> Column:
    """Whether one exchange of adjacent characters turns ``a`` into ``b``, of equal length."""
    places = F.sequence(F.lit(0), F.length(a) - 2)
    turned = lambda i: F.concat(_cut(a, 0, i), _cut(a, i + 1, 1), _cut(a, i, 1), _cut(a, i + 2, F.length(a)))
    return (F.length(a) == F.length(b)) & (F.length(a) >= 2) & F.exists(F.when(F.length(a) >= 2, places), lambda i: turned(i) == b)


def _within_one(a: Column, b: Column) -> Column:
    return (F.levenshtein(a, b, 1) >= 0) | (F.levenshtein(a, b, 2) >= 0) & _exchanged(a, b)


def _exchange_and_more(a: Column, b: Column) -> Column:
    """Whether an exchange and one more edit, none of which touches the other, turn ``a`` into ``b``."""
    n, m = F.length(a), F.length(b)

    def at(i: Column) -> Column:
        pair = F.concat(_cut(a, i + 1, 1), _cut(a, i, 1))
        before, behind, left = _cut(a, 0, i), _cut(a, i + 2, n), n - i - 2
        first = (_cut(b, 0, i + 2) == F.concat(before, pair)) & _within_one(behind, _cut(b, i + 2, m))
        second = (m >= left + 2) & (_cut(b, F.greatest(m - left - 2, F.lit(0)), m) == F.concat(pair, behind)) & _within_one(before, _cut(b, 0, m - left - 2))
        return first | second

    return (n >= 2) & F.exists(F.when(n >= 2, F.sequence(F.lit(0), n - 2)), at)


def name_distance(a: Column, b: Column, mask_a: Column | None = None, mask_b: Column | None = None) -> Column:
    """The optimal string alignment distance of two names if it is at most 2, else null."""
    mask_a, mask_b = _mask(a) if mask_a is None else mask_a, _mask(b) if mask_b is None else mask_b
    # Characters that only one side has: each takes an edit other than an exchange.
    lone = F.greatest(F.bit_count(mask_a.bitwiseAND(F.bitwise_not(mask_b))), F.bit_count(mask_b.bitwiseAND(F.bitwise_not(mask_a))))
    near = (F.abs(F.length(a) - F.length(b)) <= MOST) & (lone <= MOST)
    plain = F.when(a == b, 0).when(F.levenshtein(a, b, 1) >= 0, 1).when(F.levenshtein(a, b, 2) >= 0, F.when(_exchanged(a, b), 1).otherwise(2))
    # An exchange is two plain edits and leaves the characters and the length as they are.
    other = (F.abs(F.length(a) - F.length(b)) <= 1) & (lone <= 1) & (F.levenshtein(a, b, 4) >= 0)
    return F.when(near, F.coalesce(plain, F.when(other, F.when(_exchange_and_more(a, b), 2))))


def near_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left, right, distance) of all pairs of distinct names, in the columns ``name`` of both sides, at most two edits apart."""
    keyed = []
    for frame, keys, own in ((left, piece_keys, "left"), (right, substring_keys, "right")):
        names = frame.select(F.col("name").alias(own)).filter(F.col(own) != "").distinct()
        names = names.withColumn(f"{own}_mask", _mask(F.col(own)))
        keyed.append(names.select(own, f"{own}_mask", F.explode(keys(F.col(own))).alias("key")))
    distance = name_distance(F.col("left"), F.col("right"), F.col("left_mask"), F.col("right_mask"))
    # Both sides grow with the input: they are shuffled, never broadcast, and hot keys are left to the skew join.
    met = keyed[0].alias("l").join(keyed[1].hint("merge").alias("r"), (F.col("l.key") == F.col("r.key")) & distance.isNotNull())
    return met.select("left", "right").distinct().withColumn("distance", name_distance(F.col("left"), F.col("right")))


def misspelt(vendor_id: Column, name: Column) -> Column:
    """The name with two adjacent characters exchanged where crc32 of the id is even, at the place that the crc32 names."""
    h, n = F.crc32(vendor_id.cast("string").cast("binary")), F.length(name)
    at = F.pmod(h, F.greatest(n - 1, F.lit(1)).cast("long")).cast("int")
    turned = F.concat(_cut(name, 0, at), _cut(name, at + 1, 1), _cut(name, at, 1), _cut(name, at + 2, n))
    return F.when((h % 2 == 0) & (n >= 2), turned).otherwise(name)


def name_join(vendors: DataFrame, clients: DataFrame) -> DataFrame:
    """(vendor_id, distance, n_clients, first_client_id, clients_crc) for each vendor and distance up to 2 with a client's name.

    Reads vendor_id and name of ``vendors``, client_id and name of ``clients``, and no other
    column, whatever its name. Names are compared as they stand, by code points; a null or
    empty one takes no part. Every row of clients counts, repeated ones too; a null client_id
    counts in n_clients alone. Equal names of a vendor_id are one; different ones count each,
    a null vendor_id being one id that has no misspelling. Very long names are compared whole.
    Without rows on either side there is no row.
    """
    scratch = Scratch(vendors.sparkSession, "names")
    clients = clients.select(F.col("client_id").cast("long").alias("client_id"), F.col("name").cast("string").alias("name")).filter(F.col("name") != "")
    crc = F.crc32(F.col("client_id").cast("string").cast("binary"))
    by_name = clients.groupBy("name").agg(F.count("*").alias("n"), F.min("client_id").alias("first"), F.sum(crc).alias("crc"))
    by_name = scratch.keep(by_name, "clients")
    vendors = vendors.select(F.col("vendor_id").cast("long").alias("vendor_id"), F.col("name").cast("string").alias("name")).filter(F.col("name") != "")
    spelt = vendors.select("vendor_id", misspelt(F.col("vendor_id"), F.col("name")).alias("name")).distinct()
    pairs = near_names(spelt, by_name)
    # One row for each vendor's name, distance and client's name; clients of a hot name are already one row.
    found = pairs.join(by_name.hint("merge").withColumnRenamed("name", "right"), "right")
    sums = found.groupBy("left", "distance").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("crc").alias("crc"))
    joined = spelt.withColumnRenamed("name", "left").join(sums.hint("merge"), "left")
    return joined.groupBy("vendor_id", "distance").agg(F.sum("n").alias("n_clients"), F.min("first").alias("first_client_id"), F.sum("crc").alias("clients_crc"))


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text of ASCII characters, bit by bit."""
    octets = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    bits = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {bits}), 4294967295)"


def name_join_sql() -> str:
    """DuckDB SQL for ``name_join`` over vendors and clients, by comparing all pairs of names.

    The engine's distances count bytes and let an exchanged pair be edited again, so letters
    beyond ASCII become signs that no name has, and exchanges are looked for by place.
    """
    plain = "translate(name, 'ÉÖÄÜéöäüßñçáàâíîóôúûè', '0123456789!#$%&()*+,=')"
    crc = lambda column: _crc32_sql(f"CAST({column} AS VARCHAR)")
    one = lambda a, b: f"(levenshtein({a}, {b}) <= 1 OR damerau_levenshtein({a}, {b}) <= 1)"
    return f"""
WITH v AS (SELECT vendor_id, name, length(name) AS n, {crc("vendor_id")} AS h FROM (SELECT vendor_id, {plain} AS name FROM vendors WHERE name <> '')),
s AS (SELECT DISTINCT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2 THEN left(name, k - 1) || name[k + 1] || name[k] || name[k + 2:] ELSE name END AS a FROM (SELECT *, 1 + h % greatest(n - 1, 1) AS k FROM v)),
c AS (SELECT client_id, {plain} AS b FROM clients WHERE name <> ''),
p AS (SELECT DISTINCT a, b, damerau_levenshtein(a, b) AS d FROM (SELECT DISTINCT a FROM s), (SELECT DISTINCT b FROM c) WHERE abs(length(a) - length(b)) <= 2 AND damerau_levenshtein(a, b) <= 2),
k AS (SELECT DISTINCT a, b FROM (SELECT a, b, unnest(range(1, length(a))) AS k FROM p WHERE d = 2)
  WHERE (left(b, k + 1) = left(a, k - 1) || a[k + 1] || a[k] AND {one("a[k + 2:]", "b[k + 2:]")})
     OR (length(b) >= length(a) - k + 1 AND right(b, length(a) - k + 1) = a[k + 1] || a[k] || a[k + 2:] AND {one("left(a, k - 1)", "left(b, length(b) - length(a) + k - 1)")})),
m AS (SELECT p.a, p.b, d FROM p LEFT JOIN k ON p.a = k.a AND p.b = k.b WHERE d < 2 OR levenshtein(p.a, p.b) = 2 OR k.a IS NOT NULL)
SELECT vendor_id, d::INT AS distance, count(*) AS n_clients, min(client_id) AS first_client_id, sum({crc("client_id")})::BIGINT AS clients_crc
FROM s JOIN m ON s.a = m.a JOIN c ON c.b = m.b GROUP BY vendor_id, d
"""
