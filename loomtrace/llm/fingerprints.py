"""Document fingerprints from closed syncmers, as DataFrame expressions.

The letters of the alphabet are short pieces of a text: up to sixteen characters, ended
by one of a fixed class (``ENDS``: some vowels, digits and all beyond ASCII) or by white
space, which is passed over. So where a letter ends depends on the characters there and
not on what stands around; a word has one to four letters, and a script without white
space has one for each character. A k-mer of six letters holds five inner pairs; it is a
closed syncmer, and so an anchor, if the pair with the least hash is its first or its
last. Whether it is one depends on the k-mer alone, and of any four k-mers on end one
is: an edit changes the anchors that it touches and no others. A text with fewer letters
has its whole sequence as the one anchor, and a text without any has none.

A fingerprint is the sequence of a text's marks. A mark is an anchor and the number of
letters from the anchor before it: marks of two texts match where the anchors are equal
and the texts line up from the one before, wherever in the texts that is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.pieces import with_pieces

#: Letters of a k-mer and of its inner substrings.
K, S = 6, 2
#: Characters that end a letter, and all others but white space.
ENDS = r"[aeoAEO0-9\x{80}-\x{10FFFF}]"
_INSIDE = r"[^aeoAEO0-9\x20\x09-\x0D\x{80}-\x{10FFFF}]"
LETTER = rf"{_INSIDE}{{0,15}}{ENDS}|{_INSIDE}{{1,16}}"
#: Bits of a mark that hold the gap from the anchor before, which is four letters at most, and bits in all.
GAP_BITS, MARK_BITS = 4, 32
#: Rows of a piece of the doc_id order that are aimed at.
PIECE_ROWS = 1_000


def _hashed(letters: Column) -> Column:
    return F.zip_with(F.slice(letters, F.lit(1), F.size(letters) - 1), F.slice(letters, F.lit(2), F.size(letters) - 1), lambda a, b: F.xxhash64(a, b))


def _add_anchors(frame: DataFrame, text: str, at: str, anchors: str) -> DataFrame:
    """``frame`` with the places (numbers of their first letters) and the hashes of the anchors of its column ``text``.

    The letters and the hashes of pairs are columns of their own, so that each is computed once.
    """
    w, g = f"__letters_{at}", f"__pairs_{at}"
    inner = K - S + 1
    frame = frame.withColumn(w, F.regexp_extract_all(text, F.lit(LETTER), F.lit(0)))
    frame = frame.withColumn(g, F.when(F.size(w) > 1, _hashed(F.col(w))).otherwise(F.transform(w, lambda x: F.xxhash64(x))))
    pair = lambda i, j: F.get(F.col(g), i + j)
    # The first or the last pair is below or like all between, and one of the two is below the other.
    least = lambda i: F.least(*[pair(i, j) for j in range(1, inner - 1)])
    closed = lambda i: F.least(pair(i, 0), pair(i, inner - 1)) <= least(i)
    places = F.filter(F.sequence(F.lit(0), F.size(g) - inner), closed)
    none, one = F.array().cast("array<int>"), F.array(F.lit(0))
    frame = frame.withColumn(at, F.when(F.size(g) >= inner, places).when(F.size(g) > 0, one).otherwise(none))
    whole = F.transform(at, lambda i: F.xxhash64(g))
    many = F.transform(at, lambda i: F.xxhash64(*[pair(i, j) for j in range(0, inner, S)]))
    return frame.withColumn(anchors, F.when(F.size(g) >= inner, many).otherwise(whole)).drop(w, g)


def _add_marks(frame: DataFrame, text: str, into: str) -> DataFrame:
    """``frame`` with the marks of its column ``text``: whole numbers of MARK_BITS bits, in the order of the text."""
    at, anchors = f"__at_{into}", f"__anchors_{into}"
    frame = _add_anchors(frame, text, at, anchors)
    before = F.concat(F.slice(at, 1, 1), F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0))))  # the first has no gap
    top = F.lit(1 << (MARK_BITS - GAP_BITS)).cast("long")
    gaps = F.zip_with(at, before, lambda a, b: a - b)
    mark = F.zip_with(anchors, gaps, lambda a, gap: F.pmod(a, top) * (1 << GAP_BITS) + gap)
    return frame.withColumn(into, mark).drop(at, anchors)


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, position, anchor): the anchors of every text of ``docs`` (doc_id, text) with the number of their first letter.

    Equal anchors at positions whose difference is the same line two texts up. A null
    text counts as empty and has none.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = _add_anchors(rows, "text", "at", "anchors")
    return found.select("doc_id", F.explode(F.arrays_zip("at", "anchors")).alias("x")).select("doc_id", F.col("x.at").alias("position"), F.col("x.anchors").alias("anchor"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of the distinct marks of two fingerprints; 1 if both are empty."""
    total = F.size(F.array_union(a, b))
    return F.when(total == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / total)


def fingerprint(marks: Column) -> Column:
    """The marks as base64 of four bytes each, the greatest first."""
    return F.base64(F.unhex(F.array_join(F.transform(marks, lambda x: F.lpad(F.hex(x), MARK_BITS // 4, "0")), "")))


def marks_of(fingerprint: Column) -> Column:
    """The marks that a fingerprint holds."""
    digits = F.hex(F.unbase64(fingerprint))
    return F.transform(F.regexp_extract_all(digits, F.lit(f".{{{MARK_BITS // 4}}}"), F.lit(0)), lambda x: F.conv(x, 16, 10).cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, own, next_text, next_own): each document with its marks and those of the next by doc_id.

    After the last document comes the first. Rows that share a doc_id follow each
    other by their texts. A row with a null doc_id stands outside the order: its next
    text is null. The order is cut into pieces, each sorted by itself; only the last
    row of a piece is joined to the first of the next one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = with_pieces(rows.filter("doc_id is not null"), "doc_id", PIECE_ROWS)
    order = Window.partitionBy("piece").orderBy("doc_id", "text")
    pieces = placed.repartition("piece").sortWithinPartitions("piece", "doc_id", "text")
    inside = _add_marks(pieces, "text", "own")
    inside = inside.withColumn("next_text", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order))
    columns = ["doc_id", "text", "own", "next_text", "next_own"]
    inside = inside.filter("next_text is not null").select(*columns)

    # One row for each piece, 262,144 at most: its first and last doc_id, and the first of the next piece or of the first one.
    bounds = placed.groupBy("piece").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    around = Window.orderBy("piece")
    start = F.first("low").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    bounds = bounds.select("low", "high", F.coalesce(F.lead("low").over(around), start).alias("after"))
    last = placed.join(F.broadcast(bounds.select(F.col("high").alias("doc_id"), "after")), "doc_id").groupBy("doc_id", "after").agg(F.max("text").alias("text"))
    first = placed.join(F.broadcast(bounds.select(F.col("low").alias("doc_id"))), "doc_id").groupBy(F.col("doc_id").alias("after")).agg(F.min("text").alias("next_text"))
    edges = _add_marks(_add_marks(last.join(first, "after"), "text", "own"), "next_text", "next_own").select(*columns)

    outside = _add_marks(rows.filter("doc_id is null"), "text", "own")
    outside = outside.select("doc_id", "text", "own", F.lit(None).cast("string").alias("next_text"), F.slice("own", 1, 0).alias("next_own"))
    return inside.union(edges).union(outside)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document of ``docs`` (doc_id, text; other columns are not read) and of its edited text.

    The edited text has the last floor(n_chars / 4) code points replaced by as many
    first ones of the next document (``with_next``), or all of them if it is shorter.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next and n_anchors; the two likenesses are those of the
    fingerprints' marks. A null text counts as empty; empty texts, and texts of white
    space, are all alike. For a null doc_id nothing is put in the place of what the edit
    takes away. Very long texts are read whole. No row: no row.
    """
    found = with_next(docs)
    n = F.length("text")
    moved = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - moved), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), moved))
    found = found.withColumn("edited", edited).withColumn("n_chars", n.cast("long"))
    found = found.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    found = _add_marks(found.drop("text", "next_text"), "edited", "changed")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        F.size("own").cast("long").alias("n_anchors"),
    )
