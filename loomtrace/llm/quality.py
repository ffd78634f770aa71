"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Trees grow level by level on binned statistics; the fitted forest is a few flat
arrays (feature, threshold, children, value), which numpy walks for all rows and
trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.batches import map_batches, slices
from loomtrace.llm.language import held_out
from loomtrace.llm.shingles import mix, words

#: Labelled rows that the trees are fitted on at most: those with the least hash of doc_id.
SAMPLE_ROWS = 20_000

FEATURES = (
    "log_bytes", "letters", "upper", "digits", "blanks", "line_ends", "stops", "marks", "bangs", "bars",
    "log_words", "word_bytes", "distinct_words", "repeats", "distinct_pairs",
)

_LETTER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _MARK, _BANG, _BAR, _INNER = range(10)


def _classes() -> np.ndarray:
    """The class of each byte; bytes from 0xC0 begin a letter, those from 0x80 go on with it."""
    table = np.full(256, _MARK, np.uint8)
    for low, high, kind in (("a", "z", _LETTER), ("A", "Z", _UPPER), ("0", "9", _DIGIT)):
        table[ord(low) : ord(high) + 1] = kind
    table[[0x20, 0x09, 0x0B, 0x0C]] = _BLANK
    table[[0x0A, 0x0D]] = _LINE
    table[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
    table[ord("!")], table[ord("|")] = _BANG, _BAR
    table[0x80:0xC0], table[0xC0:] = _INNER, _LETTER
    return table


_CLASS = _classes()


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each UTF-8 text data[offsets[i]:offsets[i + 1]]; an empty text has zeros."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    kinds = _CLASS[data]
    at = np.repeat(np.arange(n) * 10, sizes)
    counts = np.bincount(at + kinds, minlength=10 * n).reshape(n, 10).astype(float)
    chars = np.maximum(1, sizes - counts[:, _INNER])
    letters = counts[:, _LETTER] + counts[:, _UPPER]
    hashes, first = words(data, offsets)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pairs = np.zeros(len(hashes), np.uint64)
    pairs[:-1] = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    distinct = _distinct(hashes, owner, n)
    inner = np.zeros(len(hashes), bool)
    inner[:-1] = owner[:-1] == owner[1:]
    distinct_pairs = _distinct(pairs[inner], owner[inner], n)
    some = np.maximum(1, n_words)
    solid = sizes - counts[:, _BLANK] - counts[:, _LINE]
    return np.column_stack([
        np.log1p(sizes), letters / chars, counts[:, _UPPER] / np.maximum(1, letters), counts[:, _DIGIT] / chars, counts[:, _BLANK] / chars,
        counts[:, _LINE] / chars, counts[:, _STOP] / chars, counts[:, _MARK] / chars, counts[:, _BANG] / chars, counts[:, _BAR] / chars,
        np.log1p(n_words), solid / some, distinct / some, np.bincount(owner[same], minlength=n) / some, distinct_pairs / np.maximum(1, n_words - 1),
    ])


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each owner; owners ascend."""
    if not len(values):
        return np.zeros(n)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[fresh], minlength=n)


@dataclass
class Forest:
    """Flat trees: row by row, x[feature] <= threshold goes left; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row."""
        out = np.full(len(x), self.start)
        for low in range(0, len(x), 4096):
            part = x[low : low + 4096]
            rows = np.arange(len(part))[:, None]
            at = np.repeat(self.roots[None, :], len(part), axis=0)
            for _ in range(self.depth):
                at = np.where(part[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[low : low + 4096] += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, smooth: float = 1.0, least: int = 5) -> Forest:
    """Boosted trees for the logistic loss; without rows, or with one label only, a constant near that label."""
    base = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(base / (1 - base)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if len(y) else np.empty(0) for column in x.T]
    binned = np.column_stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)]) if len(y) else np.empty((0, x.shape[1]), int)
    raw = np.full(len(y), start)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        feature.append(0)
        threshold.append(0.0)
        left.append(len(left))
        right.append(len(right))
        value.append(0.0)
        return len(value) - 1

    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-raw))
        slope, bend = y - p, p * (1 - p)
        roots.append(root := node())
        level = [(root, np.arange(len(y)))]
        for step in range(depth + 1):
            below = []
            for at, rows in level:
                g, h = slope[rows].sum(), bend[rows].sum()
                best = (1e-6, -1, 0)
                for j in range(x.shape[1]) if step < depth and len(rows) >= 2 * least else ():
                    cells = binned[rows, j]
                    k = len(edges[j]) + 1
                    gl, hl = np.cumsum(np.bincount(cells, slope[rows], k))[:-1], np.cumsum(np.bincount(cells, bend[rows], k))[:-1]
                    nl = np.cumsum(np.bincount(cells, minlength=k))[:-1]
                    gain = gl**2 / (hl + smooth) + (g - gl) ** 2 / (h - hl + smooth) - g**2 / (h + smooth)
                    gain[(nl < least) | (len(rows) - nl < least)] = -1
                    if len(gain) and gain[i := int(np.argmax(gain))] > best[0]:
                        best = (gain[i], j, i)
                if best[1] < 0:
                    value[at] = rate * g / (h + smooth)
                    raw[rows] += value[at]
                    continue
                _, j, i = best
                feature[at], threshold[at] = j, edges[j][i]
                goes = binned[rows, j] <= i
                left[at], right[at] = node(), node()
                below += [(left[at], rows[goes]), (right[at], rows[~goes])]
            level = below
    return Forest(np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(right, np.int32), np.array(value), np.array(roots, np.int64), depth, start)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, label) of at most ``most`` rows of ``labels`` whose crc32(doc_id) mod 3 is not 1, those with the least hash.

    Rows with a null id or another label than 0 and 1 teach nothing.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), 3, 1)).distinct()
    # The limit proves the bound of what is broadcast: 20,000 rows of 12 bytes.
    known = known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id", "label").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(known), "doc_id").select("place", "label", "text")

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            x = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["place", "label", "x"])

    rows = map_batches(joined, scan, "place long, label int, x array<double>").orderBy("place", "label", "x").limit(most).collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return x, np.array([r.label for r in rows], float)


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text; other columns are not read); a null text counts as empty."""

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(forest.scores(statistics(data, offsets)))], names=["doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(source, scan, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted): fits on at most ``most`` rows of ``labels`` (doc_id, quality) and scores every row of ``docs``.

    Equal texts have equal scores. With no labels every score is 0.5. A row with a
    null doc_id is scored and counts as held out. Rows of a repeated id are scored each by
    its own text, very long texts whole; no other column is read, whatever its name. Of
    splits that gain alike the first feature and the least threshold count. No row: no row.
    """
    scored = score(docs, fit(*training_rows(docs, labels, most)))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5, most: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, as ``quality`` does; columns are unchanged. With no labels all rows stay."""
    forest = fit(*training_rows(docs, labels, most))

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in slices(batches):
            yield batch.filter(pa.array(forest.scores(statistics(data, offsets)) >= least))

    return map_batches(docs, scan, docs.schema)
