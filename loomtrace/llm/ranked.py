"""Ranked lexical search: a blocked sparse product of items by terms and terms by documents.

Documents are cut to terms once; what is written of them is a sparse row for the terms
that the items of a block hold. Impacts of terms in documents are 64-bit integers. A
task merges the rows of the product for a block of documents at a time, adding each
term's impact to all items that hold the term, and keeps the best documents of each
item; those meet in two steps.

Items are few against documents. They are dealt into blocks by a hash of their id, so
that what a worker holds of them is bounded however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.batches import map_batches, slices
from loomtrace.llm.scratch import Scratch
from loomtrace.llm.shingles import words

#: Bytes of item text in a block, about: a block goes to the driver and to every worker.
BLOCK_BYTES = 8 << 20
#: Sums that a worker holds at once: items by documents of a block.
CELLS = 1 << 20
#: Parts of an item's candidates in the first step of the last reduction.
PARTS = 64

#: Bytes between terms: all of ASCII but digits and letters.
BETWEEN = np.zeros(256, bool)
BETWEEN[:128] = True
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    BETWEEN[_low : _high + 1] = False


@dataclass
class Items:
    """A block of items: the distinct terms, and for each the items that hold it (compressed rows)."""

    ids: list[int | None]
    terms: np.ndarray
    first: np.ndarray
    holders: np.ndarray


def item_block(rows: list[tuple[int | None, str | None]]) -> Items:
    """Items by id; the terms of an item are those of all rows with its id, once each."""
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is None, i or 0))
    at = {i: n for n, i in enumerate(ids)}
    texts = [(text or "").encode() for _, text in rows]
    ends = np.cumsum([0] + [len(t) for t in texts])
    hashes, first = words(np.frombuffer(b"".join(texts), np.uint8), ends, BETWEEN)
    owner = np.repeat(np.array([at[i] for i, _ in rows], np.int64), np.diff(first))
    terms, place = np.unique(hashes, return_inverse=True)
    pairs = np.unique(place.astype(np.int64) * max(1, len(ids)) + owner)
    holders, place = pairs % max(1, len(ids)), pairs // max(1, len(ids))
    return Items(ids, terms, np.searchsorted(place, np.arange(len(terms) + 1)), holders)


def sparse_rows(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: how many it has, and which of the items' terms how often."""
    known = items.terms

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            hashes, first = words(data, offsets, BETWEEN)
            n = np.diff(first)
            place = np.searchsorted(known, hashes)
            hit = place < len(known)
            hit[hit] = known[place[hit]] == hashes[hit]
            owner = np.repeat(np.arange(len(n)), n)[hit]
            pairs, counts = np.unique(owner * max(1, len(known)) + place[hit], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(n) + 1) * max(1, len(known))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in ((pairs % max(1, len(known))).astype(np.int32), counts.astype(np.int64))]
            made = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int64)), *lists], names=["doc_id", "n", "terms", "counts"])
            yield made.filter(pa.array(n > 0))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(source, scan, "doc_id long, n long, terms array<int>, counts array<long>")


def weights(total: int, holding: np.ndarray) -> np.ndarray:
    """Of each term: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


def impacts(weight: np.ndarray, count: np.ndarray, size: np.ndarray, total: int, length: int) -> np.ndarray:
    """Of each (document, term): the weight by the term's saturated count in a document of ``size`` terms."""
    scale = 10 + (90 * size * total) // max(1, length)
    return weight * ((1_000_000_000 * count) // (1000 * count + 8 * scale))


class Best:
    """The best (score, doc_id) of each item so far; of equal scores the least doc_id, a null one last."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.floor = np.ones(items, np.int64)
        self.item, self.score, self.doc, self.null = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, sums: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        """``sums`` has a row for each document and a column for each item."""
        row, item = np.nonzero(sums >= self.floor)
        if not len(row):
            return
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, sums[row, item]))
        doc, null = np.concatenate((self.doc, docs[row])), np.concatenate((self.null, null[row]))
        order = np.lexsort((doc, null, -score, item))
        numbers = np.arange(len(self.floor))
        place = np.arange(len(order)) - np.searchsorted(item[order], numbers)[item[order]]
        kept = order[place < self.most]
        self.item, self.score, self.doc, self.null = item[kept], score[kept], doc[kept], null[kept]
        # A later document with the last kept score may still have a lower id.
        ends = np.searchsorted(self.item, numbers, "right")
        full = ends - np.searchsorted(self.item, numbers) == self.most
        self.floor[full] = self.score[ends[full] - 1]


def scored(sparse: DataFrame, items: Items, total: int, length: int, weight: np.ndarray, most: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item among those of each task, by the item's number in the block."""
    first, holders, n_items = items.first, items.holders, len(items.ids)
    width = np.diff(first)
    step = max(1, CELLS // max(1, n_items))

    def scan(batches: Iterator[pa.RecordBatch]):
        best = Best(n_items, most)
        for batch in batches:
            ids = batch.column("doc_id")
            null = np.asarray(ids.is_null())
            docs = np.asarray(ids.fill_null(0))
            size = np.asarray(batch.column("n"))
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                n = part.num_rows
                terms, counts = part.column("terms"), part.column("counts")
                per_doc = np.asarray(terms.value_lengths())
                term, count = np.asarray(terms.flatten()), np.asarray(counts.flatten())
                row = np.repeat(np.arange(n), per_doc)
                value = impacts(weight[term], count, size[low : low + n][row], total, length)
                # The rows of the items' matrix that the document's terms name, one after the other.
                each = width[term]
                begin = np.cumsum(each) - each
                at = np.arange(int(each.sum())) - np.repeat(begin, each) + np.repeat(first[:-1][term], each)
                sums = np.zeros(n * n_items, np.int64)
                np.add.at(sums, np.repeat(row * n_items, each) + holders[at], np.repeat(value, each))
                best.add(sums.reshape(n, n_items), docs[low : low + n], null[low : low + n])
        doc = pa.array(best.doc, mask=best.null)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), doc, pa.array(best.score)], names=["item", "doc_id", "score"])

    return map_batches(sparse, scan, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, most: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` documents with the highest score above 0 of each item, ranks from 1.

    Reads doc_id and text of ``docs``, item_id and text of ``items``; other columns are not
    read, whatever their names. Terms are runs of ASCII digits and letters and of all
    characters beyond ASCII; A-Z count as a-z, nothing else is folded. Terms are compared
    by 64-bit fingerprints of whole terms. A null or empty text has no term and is not
    counted; texts are read whole. Rows of one item_id are one item with the terms of all
    of them, null being an id too; each row of ``docs`` is a document, those of a repeated
    id too. Of equal scores the lower doc_id comes first, null last. Without items or
    documents there is no row.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    scratch = Scratch(spark, "ranked")
    found = []
    for number in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number) if blocks > 1 else items
        block = item_block([(r.item_id, r.text) for r in mine.collect()])
        if not len(block.ids) or not len(block.terms):
            continue
        sparse = scratch.keep(sparse_rows(docs, block), "sparse")
        total, length = sparse.agg(F.count("*"), F.sum("n")).first()
        holding = np.zeros(len(block.terms), np.int64)
        for term, count in sparse.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[term] = count
        best = scored(sparse, block, total, length or 0, weights(total, holding), most)
        for parts in (("item", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), ("item",)):
            order = Window.partitionBy(*parts).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
        # At most as many names as the block has items, which its bytes bound.
        names = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        found.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def ranked_sql(most: int = 10) -> str:
    """DuckDB SQL for ``ranked`` over documents and benchmark."""
    terms = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {terms} AS terms FROM documents),
sizes AS (SELECT count(*) AS n_docs, sum(len(terms))::HUGEINT AS length FROM d WHERE len(terms) > 0),
i AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
tf AS (SELECT doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sizes GROUP BY term),
v AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * n_docs) // length)::BIGINT))) AS impact FROM tf JOIN w USING (term), sizes),
s AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM i JOIN v USING (term) GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, rank, doc_id, score FROM (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM s) WHERE rank <= {most}
"""
