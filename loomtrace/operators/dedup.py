"""Near-duplicate tasks by the cosine of their embeddings.

Comparison stays within a domain. The stored vectors of a domain lie in cells around
pivots, one cell for BLOCK of them and CELLS at most, and a row meets only the cells that
the triangle inequality of angles cannot rule out, so no near pair is lost. A domain of
up to BLOCK vectors is one cell without a pivot. Cells and the rows that meet them are cut
into blocks of bounded size, each pair of which is one matrix product; a vector is copied
once for each block that meets its own cell, so once where a cell and what meets it are small.
Pivots, cells and counts are tables; nothing of them goes to the driver or into a broadcast
that their number would make large.

``greedy`` takes rows in order and rejects a row that is near a row accepted before;
only rows that are near some earlier row at all can depend on another, so those are
settled in rounds of joins and every other row is accepted at once.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtrace.sources.shared import ensure_checkpoints

#: Vectors of a block, cells of a domain at most, and rows that one task assigns to cells.
BLOCK, CELLS, SALT = 4_096, 256, 20_000
#: Rows of a product that is held at once.
STRIPE = 1_024
#: Slack of angles for rounding, in radians.
_SLACK = 1e-6


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays up to the shorter one's length; 0 if a norm is 0."""
    n = F.least(F.size(a), F.size(b))
    dot = lambda x, y: F.aggregate(F.zip_with(F.slice(x, F.lit(1), n), F.slice(y, F.lit(1), n), lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return F.when((norm(a) == 0) | (norm(b) == 0), 0.0).otherwise(dot(a, b) / (norm(a) * norm(b)))


def _units(values: pd.Series) -> np.ndarray:
    """Rows of length 1; those of another size than the first are cut or filled with zeros, zeros stay zeros."""
    width = max((len(v) for v in values), default=0)
    if all(len(v) == width for v in values):
        out = np.array(values.tolist(), float).reshape(len(values), width)
    else:
        out = np.zeros((len(values), width))
        for row, v in zip(out, values, strict=True):
            row[: len(v)] = v
    norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows, over as many places as both have."""
    n = min(a.shape[1], b.shape[1])
    return a[:, :n] @ b[:, :n].T


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_product(a, b), -1, 1))


def _texts(values, n: int) -> pd.Series:
    """A column of texts, as objects: those turn into one Arrow array, of no rows too."""
    return pd.Series([values] * n if isinstance(values, str) else values, dtype=object)


def vectors(rows: DataFrame) -> DataFrame:
    """(id, domain, embedding) of the rows that have a domain and a vector, the domain as text."""
    return rows.filter("domain is not null and embedding is not null").select("id", F.col("domain").cast("string").alias("domain"), "embedding")


def pivots_of(store: DataFrame) -> DataFrame:
    """(domain, cell, pivot): about one stored vector in BLOCK of each domain that has more, CELLS at most, the first by a hash of the id."""
    sizes = store.groupBy("domain").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
    sizes = sizes.withColumn("wanted", F.least(F.lit(CELLS), F.ceil(F.col("n") / BLOCK)).cast("int"))
    # The least hashes among those that are low enough to hold them all but for a chance of none.
    low = F.xxhash64(F.col("id").cast("string"), F.lit(1)).bitwiseAND(F.lit((1 << 62) - 1)) / F.lit(float(1 << 62))
    drawn = store.join(sizes, "domain").withColumn("low", low).filter(F.col("low") <= (F.col("wanted") * 4 + 40) / F.col("n"))
    # At most a few times CELLS rows of a domain meet here, whatever its size.
    listed = drawn.groupBy("domain", "wanted").agg(F.sort_array(F.collect_list(F.struct("low", "embedding"))).alias("rows"))
    rows = listed.select("domain", F.posexplode(F.slice("rows", F.lit(1), F.col("wanted"))).alias("cell", "row"))
    return rows.select("domain", "cell", F.col("row.embedding").alias("pivot"))


def _with_pivots(rows: DataFrame, pivots: DataFrame, function, schema: str) -> DataFrame:
    """Runs a function of (rows, pivots) of a domain over salted parts of the rows of each domain that has pivots."""
    known = pivots.groupBy("domain").agg(F.count("*").alias("n_cells"))
    salts = rows.join(known, "domain").groupBy("domain").agg(F.ceil(F.count("*") / SALT).cast("long").alias("salts"))
    salted = rows.join(salts, "domain").withColumn("salt", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(2)), F.col("salts"))).drop("salts")
    copies = pivots.join(salts, "domain").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    return salted.groupBy("domain", "salt").cogroup(copies.groupBy("domain", "salt")).applyInPandas(function, schema)


def place(store: DataFrame, pivots: DataFrame) -> DataFrame:
    """(other, domain, v, cell, angle): stored rows with the nearest pivot of their domain and the angle to it; cell 0 at a right angle without one."""
    key, vector = (store.schema[c].dataType.simpleString() for c in ("id", "embedding"))

    def assign(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"other": left.id, "domain": _texts(left.domain.tolist(), len(left)), "v": left.embedding, "cell": np.zeros(len(left), np.int32), "angle": np.full(len(left), np.pi / 2)})
        if len(left) and len(right):
            right = right.sort_values("cell")
            angles = _angles(_units(left.embedding), _units(right["pivot"]))
            nearest_ = angles.argmin(axis=1)
            out["cell"], out["angle"] = right.cell.to_numpy()[nearest_].astype(np.int32), angles[np.arange(len(left)), nearest_]
        return out

    near = _with_pivots(store, pivots, assign, f"other {key}, domain string, v {vector}, cell int, angle double")
    # A domain without a pivot needs no product.
    rest = store.join(pivots.select("domain").distinct(), "domain", "left_anti")
    return near.unionByName(rest.select(F.col("id").alias("other"), "domain", F.col("embedding").alias("v"), F.lit(0).alias("cell"), F.lit(np.pi / 2).alias("angle")))


def cells_of(placed: DataFrame) -> DataFrame:
    """(domain, cell, radius, n) of placed rows."""
    return placed.groupBy("domain", "cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))


def meet(rows: DataFrame, pivots: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """(id, domain, u, cell): rows once for each cell that may hold a near vector; all of a domain's cells where it has no pivot."""
    key, vector = (rows.schema[c].dataType.simpleString() for c in ("id", "embedding"))
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + _SLACK

    def choose(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": left.id[:0], "domain": _texts([], 0), "u": left.embedding[:0], "cells": _texts([], 0)})
        angles = _angles(_units(left.embedding), _units(right["pivot"]))
        held, cell = angles <= right.radius.to_numpy()[None, :] + reach, right.cell.to_numpy().astype(np.int32)
        return pd.DataFrame({"id": left.id, "domain": _texts(left.domain.tolist(), len(left)), "u": left.embedding, "cells": _texts([cell[mine] for mine in held], len(left))})

    around = pivots.join(cells.select("domain", "cell", "radius"), ["domain", "cell"])
    # A vector leaves Python once, with the list of its cells: copies for each cell are made outside, row by row.
    near = _with_pivots(rows, around, choose, f"id {key}, domain string, u {vector}, cells array<int>")
    near = near.select("id", "domain", "u", F.explode("cells").alias("cell"))
    rest = rows.join(pivots.select("domain").distinct(), "domain", "left_anti").join(cells.select("domain", "cell").filter("cell = 0"), "domain")
    return near.unionByName(rest.select("id", "domain", F.col("embedding").alias("u"), "cell"))


def pairs_of(met: DataFrame, placed: DataFrame, threshold: float, earlier: bool = False) -> DataFrame:
    """(id, other, domain, similarity) of rows and the placed rows of the cells that they meet, a block by a block at a time."""
    key = placed.schema["other"].dataType.simpleString()
    sizes = placed.groupBy("domain", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    sizes = sizes.join(met.groupBy("domain", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("pieces")), ["domain", "cell"])
    part = lambda name, of: F.pmod(F.xxhash64(F.col(name).cast("string"), F.lit(3)), F.col(of))
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    placed = placed.join(sizes, ["domain", "cell"]).withColumn("block", part("other", "blocks")).withColumn("piece", every("pieces"))
    met = met.join(sizes, ["domain", "cell"]).withColumn("piece", part("id", "pieces")).withColumn("block", every("blocks"))
    # Small cells share groups, so that a group is worth a task's while however many domains there are.
    small = (F.col("blocks") == 1) & (F.col("pieces") == 1)
    group = F.when(small, F.pmod(F.xxhash64("domain", "cell"), F.lit(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4))).otherwise(F.xxhash64("domain", "cell", "block", "piece"))
    own = ["domain", "cell", "block", "piece"]
    left, right = met.select(group.alias("g"), *own, "id", "u"), placed.select(group.alias("g"), *own, "other", "v")

    def multiply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, others, domains, cosines = [], [], [], []
        stored = {k: v for k, v in right.groupby(own, sort=False)} if len(right) else {}
        for k, asked in left.groupby(own, sort=False) if len(left) else ():
            if k not in stored:
                continue
            a, b, other = _units(asked.u), _units(stored[k].v), stored[k].other.to_numpy()
            for low in range(0, len(a), STRIPE):
                mine = asked.id.to_numpy()[low : low + STRIPE]
                found = _product(a[low : low + STRIPE], b)
                near = found >= threshold
                if earlier:
                    near &= mine[:, None] > other[None, :]
                i, j = np.nonzero(near)
                ids.append(mine[i]), others.append(other[j]), cosines.append(found[i, j]), domains.extend([k[0]] * len(i))
        if not domains:
            return pd.DataFrame({"id": left.id[:0], "other": right.other[:0], "domain": _texts([], 0), "similarity": np.zeros(0)})
        return pd.DataFrame({"id": np.concatenate(ids), "other": np.concatenate(others), "domain": _texts(domains, 0), "similarity": np.concatenate(cosines)})

    return left.groupBy("g").cogroup(right.groupBy("g")).applyInPandas(multiply, f"id {key}, other {key}, domain string, similarity double")


def near_pairs(rows: DataFrame, store: DataFrame, threshold: float, earlier: bool = False) -> DataFrame:
    """(id, other, domain, similarity) of rows and stored rows of a domain with a cosine of ``threshold`` or more.

    ``rows`` and ``store`` have id, domain and embedding. With ``earlier`` a row meets
    stored rows of lower id only. A vector of zeros is near nothing above 0, a null vector
    or domain is near nothing. All near pairs are found, of however many domains.
    """
    kind = rows.schema["domain"].dataType
    ensure_checkpoints(rows.sparkSession)
    store, rows = vectors(store), vectors(rows)
    pivots = pivots_of(store).checkpoint()
    placed = place(store, pivots)
    met = meet(rows, pivots, cells_of(placed), threshold)
    found = pairs_of(met, placed, threshold, earlier)
    return found.select("id", "other", F.col("domain").cast(kind).alias("domain"), "similarity")


def nearest(rows: DataFrame, store: DataFrame, threshold: float, earlier: bool = False) -> DataFrame:
    """The nearest stored row of each row that has one; ties go to the lower id."""
    best = F.max_by(F.struct("other", "similarity"), F.struct("similarity", -F.col("other"))).alias("best")
    return near_pairs(rows, store, threshold, earlier).groupBy("id", "domain").agg(best).select("id", "domain", "best.other", "best.similarity")


def reject_stored(rows: DataFrame, store: DataFrame, threshold: float) -> DataFrame:
    """Rows that no stored row of their domain is near to."""
    return rows.join(near_pairs(rows, store, threshold).select("id").distinct(), "id", "left_anti")


def greedy(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, domain, accepted, match) in order of id; ``match`` is the first accepted row that a rejected one is near to.

    Each round settles every row whose earlier near rows are all settled. Rounds are as
    many as the longest chain of near rows, not as many as there are rows.
    """
    ensure_checkpoints(rows.sparkSession)
    pairs = near_pairs(rows, rows, threshold, earlier=True).select("id", "other").checkpoint()
    free = rows.select("id").join(pairs.select("id").distinct(), "id", "left_anti")
    new = free.select("id", F.lit(True).alias("accepted"), F.lit(None).cast("long").alias("match"))
    settled, left = [new], pairs.withColumn("accepted", F.lit(None).cast("boolean"))
    while not left.isEmpty():
        # Only what the last round settled is new to the open rows.
        known = new.select(F.col("id").alias("other"), F.col("accepted").alias("now"))
        left = left.join(known, "other", "left").select("id", "other", F.coalesce("accepted", "now").alias("accepted")).checkpoint()
        state = left.groupBy("id").agg(
            F.min(F.when(F.col("accepted"), F.col("other"))).alias("match"), F.count_if(F.col("accepted").isNull()).alias("open"),
            F.min(F.when(F.col("accepted").isNull(), F.col("other"))).alias("first_open"),
        )
        done = state.filter((F.col("open") == 0) | (F.col("match").isNotNull() & (F.col("match") < F.col("first_open"))))
        new = done.select("id", F.col("match").isNull().alias("accepted"), "match").checkpoint()
        settled.append(new)
        left = left.join(new.select("id"), "id", "left_anti")
    return rows.select("id", "domain").join(reduce(DataFrame.union, settled), "id")
