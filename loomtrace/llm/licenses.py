"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

A text is scanned as a whole, by its paragraphs (parts between blank lines), by its
lines and by windows of its words. A part is compared with a template only if their
numbers of bigrams allow the threshold at all: templates are listed once for each size
that a partner may have, so that pruning by size is an equality join and no part meets
every template. Windows are sought only in texts that hold an anchor: of a template's
bigrams so many are anchors that no window can reach the threshold without one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.llm.scratch import Scratch

# Notices of public licences, as their licensors word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)

#: Texts are alike from this Dice coefficient on.
THRESHOLD = 0.8


def normalised_words(text: Column) -> Column:
    """Lower-case words of letters and digits of any script."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words as 64-bit hashes; a single word counts as one."""
    pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.xxhash64(a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def _templates(spark: SparkSession, templates: Iterable[tuple[str, str]], threshold: float) -> DataFrame:
    """(size, template, licence, pattern): each template once for each size of a part that may reach the threshold.

    With Dice = 2 * shared / (a + b) and shared <= min(a, b), a part of b bigrams can
    reach t against a template of a only if t / (2 - t) <= b / a <= (2 - t) / t.
    """
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "template int, licence string, body string")
    rows = rows.withColumn("words", normalised_words(F.col("body"))).withColumn("pattern", bigrams(F.col("words"))).filter(F.size("pattern") > 0)
    low = F.ceil(F.size("pattern") * (threshold / (2 - threshold)) - 1e-9)
    high = F.floor(F.size("pattern") * ((2 - threshold) / threshold) + 1e-9)
    return rows.select(F.explode(F.sequence(F.greatest(low, F.lit(1)).cast("int"), high.cast("int"))).alias("size"), "template", "licence", "pattern")


def _window_templates(spark: SparkSession, templates: Iterable[tuple[str, str]], threshold: float) -> DataFrame:
    """(template, licence, pattern, needed, most, anchors, words): what a window has to share, its greatest size, and bigrams of which it has one.

    A window shares ``needed`` = ceil(a * t / (2 - t)) of a bigrams at least, so it has
    one of any a - needed + 1 of them; those with the longest words are the rarest.
    ``words`` has the longer word of each anchor, which a text with a window holds.
    """
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "template int, licence string, body string")
    rows = rows.withColumn("words", normalised_words(F.col("body"))).withColumn("pattern", bigrams(F.col("words"))).filter(F.size("words") > 1)
    a = F.size("pattern")
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1), lambda x, y: F.struct((-F.length(x) - F.length(y)).alias("rank"), F.xxhash64(x, y).alias("gram"), F.when(F.length(x) < F.length(y), y).otherwise(x).alias("word")))
    rows = rows.withColumn("needed", F.ceil(a * (threshold / (2 - threshold)) - 1e-9).cast("int")).withColumn("most", F.floor(a * ((2 - threshold) / threshold) + 1e-9).cast("int"))
    chosen = F.slice(F.array_sort(F.array_distinct(pairs)), F.lit(1), a - F.col("needed") + 1)
    return rows.select("template", "licence", "pattern", "needed", "most", F.transform(chosen, lambda x: x["gram"]).alias("anchors"), F.transform(chosen, lambda x: x["word"]).alias("words"))


def _windows(rows: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(doc_id, key, ranges, found): texts of ``rows`` with windows like a template; ``found`` has structs (shared, template, licence, dice, first, last).

    A window starts and ends with a bigram of its template, for others only lower
    Dice; of the windows from one start the best counts. Where windows overlap, the one
    that shares most bigrams stands, of equal ones the one with the greater Dice.
    """
    spark = rows.sparkSession
    listed = _window_templates(spark, templates, threshold)  # of a fixed size: a row a template
    anchored = listed.select(F.explode("anchors").alias("gram"), "template").groupBy("gram").agg(F.collect_set("template").alias("held_by"))
    anchors = anchored.agg(F.map_from_entries(F.collect_list(F.struct("gram", "held_by"))).alias("by_anchor")).withColumn("one", F.lit(1))
    # Only texts with an anchor's word are paired to bigrams.
    held = [r.word for r in listed.select(F.explode("words").alias("word")).distinct().orderBy("word").collect()]
    listed = listed.drop("words")
    has_word = F.arrays_overlap(normalised_words(F.col("text")), F.array(*map(F.lit, held)).cast("array<string>"))
    texts = rows.filter(has_word).select("doc_id", "text", F.xxhash64("text").alias("key")).withColumn("words", normalised_words(F.col("text")))
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1), lambda x, y: F.xxhash64(x, y))
    texts = texts.filter(F.size("words") > 1).withColumn("g", pairs).drop("words")
    # The one row of anchors tells which templates a text may hold, and only those are joined to it.
    texts = texts.withColumn("one", F.lit(1)).join(F.broadcast(anchors), "one").withColumn("hits", F.array_intersect("g", F.map_keys("by_anchor"))).filter(F.size("hits") > 0)
    held_by = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.element_at("by_anchor", x))))
    near = texts.withColumn("template", F.explode(held_by)).drop("one", "by_anchor", "hits").join(F.broadcast(listed), "template")
    near = near.filter(F.size(F.array_intersect("g", "pattern")) >= F.col("needed")).drop("anchors")
    at = F.filter(F.transform("g", lambda x, i: F.when(F.array_contains("pattern", x), i)), lambda i: i.isNotNull())
    near = near.withColumn("at", at)
    far = lambda i, k: F.coalesce(F.get("at", k + F.col("needed") - 1) - i < F.col("most"), F.lit(False))
    near = near.withColumn("starts", F.filter(F.transform("at", lambda i, k: F.when(far(i, k), i)), lambda i: i.isNotNull())).filter(F.size("starts") > 0)
    near = near.select("doc_id", "text", "key", "g", "template", "licence", "pattern", "most", F.explode("starts").alias("first"))
    near = near.withColumn("s", F.slice("g", F.col("first") + 1, F.col("most"))).drop("g")
    # Whether each bigram is new to the window and, if it is, of the template.
    near = near.withColumn("news", F.transform("s", lambda x, k: F.when(F.array_position("s", x) == k + 1, F.when(F.array_contains("pattern", x), 2).otherwise(1)).otherwise(0)))
    empty = F.struct(F.lit(0).alias("shared"), F.lit(0).alias("size"), F.lit(0).alias("at"), F.lit(0.0).alias("dice"), F.lit(0).alias("best_shared"), F.lit(0).alias("length"))

    def step(state, new):
        shared, size, at = state["shared"] + F.when(new == 2, 1).otherwise(0), state["size"] + F.when(new > 0, 1).otherwise(0), state["at"] + 1
        dice = 2 * shared / (size + F.size("pattern"))
        better = (new == 2) & (dice > state["dice"])
        best = lambda now, name: F.when(better, now).otherwise(state[name]).alias(name)
        return F.struct(shared.alias("shared"), size.alias("size"), at.alias("at"), best(dice, "dice"), best(shared, "best_shared"), best(at, "length"))

    near = near.withColumn("w", F.aggregate("news", empty, step)).filter(F.col("w.dice") >= threshold)
    last = F.col("first") + F.col("w.length")
    one = F.struct((-F.col("w.best_shared")).alias("shared"), (-F.col("w.dice")).alias("less"), "template", "first", last.alias("last"), "licence", F.col("w.dice").alias("dice"))
    found = near.groupBy("doc_id", "key", "text").agg(F.array_sort(F.collect_set(one)).alias("all"))
    meets = lambda x, y: (x["first"] <= y["last"]) & (y["first"] <= x["last"])
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda out, w: F.when(F.exists(out, lambda o: meets(o, w)), out).otherwise(F.concat(out, F.array(w))))
    return found.select("doc_id", "key", "text", kept.alias("kept"))


def _ranges(parts: Column, kind: str) -> Column:
    """Structs (part, number, first, last): the words that each part has, counted over the whole text."""
    counts = F.transform(parts, lambda x: F.size(normalised_words(x)))
    nothing = F.struct(F.lit(0).alias("after"), F.slice(F.array(F.struct(F.lit(kind).alias("part"), F.lit(0).alias("number"), F.lit(0).alias("first"), F.lit(0).alias("last"))), 1, 0).alias("rows"))
    row = lambda s, n: F.struct(F.lit(kind).alias("part"), F.size(s["rows"]).alias("number"), s["after"].alias("first"), (s["after"] + n - 1).alias("last"))
    return F.aggregate(counts, nothing, lambda s, n: F.struct((s["after"] + n).alias("after"), F.concat(s["rows"], F.array(row(s, n))).alias("rows")), lambda s: s["rows"])


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, part, number, licence, template, dice): the parts of texts that are like a template, each with its best one.

    ``part`` is ``text``, ``paragraph``, ``line`` or ``window`` and ``number`` counts
    from 0; a paragraph that is the whole text, and a line that is a whole paragraph, are
    not parts of their own. A window is a run of words at any place, ``number`` that of
    its first word; it comes out unless a text, paragraph or line that does so too with
    the same licence shares words with it. Of equally like templates the first of the
    list wins. Null and empty texts have no part that is like one. Rows with a null id
    count as one more id; equal parts of rows that share an id come out once. Every text
    is scanned whole.
    """
    spark = docs.sparkSession
    templates = list(templates)
    listed = _templates(spark, templates, threshold)  # of a fixed size: len(templates) times the sizes that each allows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    paragraphs, lines = F.split("text", r"\n[ \t\r]*\n\s*"), F.split("text", r"\n")
    whole = F.array(F.struct(F.lit("text").alias("part"), F.lit(0).alias("number"), F.col("text").alias("body")))
    nothing = F.slice(whole, 1, 0)
    number = lambda kind, parts: F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("part"), i.alias("number"), x.alias("body")))
    split = rows.withColumn("paragraphs", paragraphs).withColumn("lines", lines)
    parts = F.concat(
        whole,
        F.when(F.size("paragraphs") > 1, number("paragraph", F.col("paragraphs"))).otherwise(nothing),
        F.when(F.size("lines") > F.size("paragraphs"), number("line", F.col("lines"))).otherwise(nothing),
    )
    found = split.select("doc_id", F.xxhash64("text").alias("key"), F.explode(parts).alias("p")).select("doc_id", "key", "p.part", "p.number", "p.body")
    found = found.withColumn("words", normalised_words(F.col("body"))).drop("body")  # a column of its own: split once
    found = found.withColumn("grams", bigrams(F.col("words"))).drop("words").withColumn("size", F.size("grams"))
    pairs = found.join(F.broadcast(listed), "size")
    shared = F.size(F.array_intersect("grams", "pattern"))
    pairs = pairs.withColumn("dice", 2 * shared / (F.col("size") + F.size("pattern"))).filter(F.col("dice") >= threshold)
    best = F.max(F.struct("dice", (-F.col("template")).alias("last"), "licence")).alias("best")
    grouped = pairs.groupBy("doc_id", "part", "number", "grams").agg(best, F.collect_set("key").alias("keys"))
    columns = ["doc_id", "part", "number", "licence", "template", "dice"]
    grouped = grouped.select("doc_id", "part", "number", "best.licence", (-F.col("best.last")).alias("template"), "best.dice", "keys")
    grouped = Scratch(spark, "licenses").keep(grouped, "parts")  # the windows' join reads it too

    windows = _windows(rows, templates, threshold).withColumn("paragraphs", paragraphs).withColumn("lines", lines)
    ranges = F.concat(_ranges(F.array("text"), "text"), _ranges(F.col("paragraphs"), "paragraph"), _ranges(F.col("lines"), "line"))
    windows = windows.withColumn("ranges", ranges).drop("text", "paragraphs", "lines")
    told = grouped.select(F.col("doc_id").alias("told_id"), F.explode("keys").alias("told_key"), F.struct("part", "number", "licence").alias("x"))
    told = told.groupBy("told_id", "told_key").agg(F.collect_set("x").alias("told"))
    windows = windows.join(told, F.col("doc_id").eqNullSafe(F.col("told_id")) & (F.col("key") == F.col("told_key")), "left")
    same = lambda w, r, x: (x["licence"] == w["licence"]) & (x["part"] == r["part"]) & (x["number"] == r["number"]) & (r["first"] <= w["last"]) & (w["first"] <= r["last"])
    covered = lambda w: F.exists(F.col("told"), lambda x: F.exists(F.col("ranges"), lambda r: same(w, r, x)))
    windows = windows.withColumn("w", F.explode(F.filter("kept", lambda w: ~F.coalesce(covered(w), F.lit(False)))))
    windows = windows.select("doc_id", F.lit("window").alias("part"), F.col("w.first").alias("number"), "w.licence", "w.template", "w.dice")
    return grouped.select(*columns).unionByName(windows.distinct())


def document_licenses(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licences, n_parts, best_dice) for each doc_id with a part like a template; ``licences`` is sorted and joined by commas."""
    parts = scan(docs, templates, threshold)
    grouped = parts.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"), F.count("*").alias("n_parts"), F.max("dice").alias("best_dice"))
    return grouped.select("doc_id", "licences", "n_parts", "best_dice")
