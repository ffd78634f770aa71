"""Checks of documents, archives and pages in long form; each gives (pair, score) or (file, score).

``runs`` has file or pair and side, paragraph, run, text and properties of a run;
``paragraphs`` has text, alignment, spacing; ``members`` of archives has name, digest and
text; ``nodes`` of pages has node, tag, text, attributes. All are aggregates, so a check
of many files is one query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtrace.functions.text import indel_ratio, line_ratio, stripped


def _score(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("double")


def every_run(runs: DataFrame, test: Column) -> DataFrame:
    """1 if all runs of a file satisfy a test, such as a font; a null test fails."""
    return runs.groupBy("file").agg(F.min(_score(test)).alias("score"))


def no_run(runs: DataFrame, test: Column) -> DataFrame:
    """1 if no run satisfies a test, such as capitals or a highlight."""
    return runs.groupBy("file").agg((1 - F.max(_score(test))).alias("score"))


def italic_at_size(runs: DataFrame, size: float = 14) -> DataFrame:
    """Every italic run has the size."""
    return every_run(runs, ~F.coalesce(F.col("italic"), F.lit(False)) | (F.col("size") == size))


def last_paragraph_struck(runs: DataFrame) -> DataFrame:
    """All runs of a file's last paragraph are struck through."""
    last = runs.groupBy("file").agg(F.max("paragraph").alias("paragraph"))
    return every_run(runs.join(last, ["file", "paragraph"]), F.col("strike"))


def page_breaks(runs: DataFrame, wanted: int | None = None) -> DataFrame:
    """There are so many page breaks, or any."""
    n = F.sum(F.col("page_break").cast("int"))
    return runs.groupBy("file").agg(_score(n == wanted if wanted is not None else n > 0).alias("score"))


def spacing_of_first(paragraphs: DataFrame, wanted: list[float]) -> DataFrame:
    """The first paragraphs have these line spacings."""
    first = paragraphs.filter(F.col("paragraph") < len(wanted))
    found = first.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "spacing"))), lambda x: x["spacing"]).alias("s"))
    return found.select("file", _score(F.col("s") == F.array(*map(F.lit, wanted))).alias("score"))


def first_words_lead(paragraphs: DataFrame) -> DataFrame:
    """Each sentence of three words and more begins with its first three, set apart from the rest by a tab."""
    sentences = paragraphs.select("file", F.explode(F.split("text", r"\.")).alias("s")).withColumn("w", F.split(stripped(F.col("s")), r"\s+")).filter(F.size("w") >= 3)
    lead = F.size(F.split(F.substring_index("s", "\t", 1), r"\s+").cast("array<string>"))
    return sentences.groupBy("file").agg(F.min(_score(F.col("s").contains("\t") & (lead >= 3))).alias("score"))


def unique_field(lines: DataFrame, field: int = 1, fields: int = 4) -> DataFrame:
    """(file, n): different values of one field of lines (file, text) that have so many fields."""
    parts = F.split("text", ",")
    return lines.filter(F.size(parts) == fields).groupBy("file").agg(F.countDistinct(F.trim(F.get(parts, F.lit(field)))).alias("n"))


def tables_equal(cells: DataFrame) -> DataFrame:
    """The same tables on both sides: positions (table, row, col) and trimmed texts."""
    side = lambda s: F.max(F.when(F.col("side") == s, stripped(F.col("text"))))
    rows = cells.groupBy("pair", "table", "row", "col").agg(side("result").alias("a"), side("expected").alias("b"))
    return rows.groupBy("pair").agg(F.min(_score(F.col("a") == F.col("b"))).alias("score"))


def images_equal(images: DataFrame) -> DataFrame:
    """The same pictures in the same order, by digests of their pixels."""
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("digest")))
    rows = images.groupBy("pair", "at").agg(side("result").alias("a"), side("expected").alias("b"))
    return rows.groupBy("pair").agg(F.min(_score(F.col("a") == F.col("b"))).alias("score"))


def references_likeness(paragraphs: DataFrame, marker: str = "References") -> DataFrame:
    """The mean likeness of the paragraphs behind the marker, by position; 0 if they are not as many."""
    start = paragraphs.filter(stripped(F.col("text")) == marker).groupBy("pair", "side").agg(F.max("paragraph").alias("start"))
    after = paragraphs.join(start, ["pair", "side"]).filter("paragraph > start").withColumn("at", F.col("paragraph") - F.col("start"))
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("text")))
    rows = after.groupBy("pair", "at").agg(side("result").alias("a"), side("expected").alias("b"))
    rows = rows.withColumn("ratio", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), indel_ratio("a", "b")))
    return rows.groupBy("pair").agg(F.when(F.count("ratio") == F.count("*"), F.avg("ratio")).otherwise(0.0).alias("score"))


def archives_likeness(members: DataFrame, by_text: bool = False) -> DataFrame:
    """The mean over members of equal digests, or of the ratio of their lines; 0 if the names differ."""
    side = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    rows = members.groupBy("pair", "name").agg(*[side(s, c).alias(f"{c}_{s}") for s in ("result", "expected") for c in ("digest", "text")])
    there = F.col("digest_result").isNotNull() & F.col("digest_expected").isNotNull()
    each = line_ratio("text_result", "text_expected") if by_text else (F.col("digest_result") == F.col("digest_expected")).cast("double")
    rows = rows.withColumn("there", there).withColumn("each", each)
    return rows.groupBy("pair").agg(F.when(F.bool_and("there"), F.avg("each")).otherwise(0.0).alias("score"))


def pages_equal(nodes: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Elements of two pages by order, as far as both go: tags, texts and attributes are the same."""
    plain = F.array_sort(F.transform(F.filter(F.map_entries("attributes"), lambda x: ~x["key"].isin(*ignore) if ignore else F.lit(True)), lambda x: F.concat(x["key"], F.lit("="), x["value"])))
    side = lambda s: F.max(F.when(F.col("side") == s, F.struct("tag", stripped(F.col("text")).alias("text"), F.array_join(plain, "\n").alias("attributes"))))
    rows = nodes.groupBy("pair", "node").agg(side("result").alias("a"), side("expected").alias("b")).filter("a is not null and b is not null")
    return rows.groupBy("pair").agg(F.min(_score(F.col("a") == F.col("b"))).alias("score"))


def video_frames_alike(frames: DataFrame, most: int = 5, frames_compared: int = 100) -> DataFrame:
    """Of the first frames (pair, side, at, hash) no more than ``most`` differ by over five bits; null where one side ends first and the other goes on."""
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("hash")))
    rows = frames.filter(F.col("at") < frames_compared).groupBy("pair", "at").agg(side("result").alias("a"), side("expected").alias("b"))
    off = F.sum((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 5).cast("int"))
    whole = F.bool_and(F.col("a").isNotNull() & F.col("b").isNotNull())
    return rows.groupBy("pair").agg(_score(whole & (off <= most)).alias("score"))


def audio_score(distances: DataFrame) -> DataFrame:
    """Scores of aligned sounds (pair, cost, steps): e to the negative mean cost; 1 if both cannot be read, 0 if one cannot."""
    one, both = F.col("result_bad") | F.col("expected_bad"), F.col("result_bad") & F.col("expected_bad")
    return distances.select("pair", F.when(both, 1.0).when(one, 0.0).otherwise(F.exp(-F.col("cost") / F.col("steps"))).alias("score"))
